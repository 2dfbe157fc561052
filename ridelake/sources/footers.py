"""The footers of Parquet files as a table: schema, rows and row groups, without reading any data.

One job opens the footers, many files to a task. Workers open files by Arrow's file systems (local, HDFS, object
stores). What they cannot open, or describe in Spark's types (nested columns and such), is left to Spark itself.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FILES_PER_TASK = 64
SCHEMA = "at long, path string, length long, fingerprint string, schema string, rows long, group_rows array<long>"
# Where Spark keeps the schema of a file it has written.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def plain_path(path: str) -> str:
    """The path that ``files.literal_path`` has escaped."""
    return re.sub(r"\\(.)", r"\1", path)


def opened(path: str):
    """A file of any store that Arrow knows, for reading at random places."""
    if path.startswith("/") or path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    scheme, _, rest = path.partition("://")
    store, _ = pafs.FileSystem.from_uri(f"{scheme}://{rest.partition('/')[0]}/")
    return store.open_input_file(rest if scheme != "hdfs" else "/" + rest.partition("/")[2])


def _kind(kind: pa.DataType, physical: str) -> T.DataType | None:
    """Spark's type of a column, None where Spark is asked instead."""
    same = {pa.int8(): T.ByteType(), pa.int16(): T.ShortType(), pa.int32(): T.IntegerType(), pa.int64(): T.LongType(),
            pa.float32(): T.FloatType(), pa.float64(): T.DoubleType(), pa.bool_(): T.BooleanType(),
            pa.date32(): T.DateType(), pa.string(): T.StringType(), pa.large_string(): T.StringType(),
            pa.null(): T.IntegerType()}
    if kind in same:
        return same[kind]
    if pa.types.is_decimal128(kind):
        return T.DecimalType(kind.precision, kind.scale)
    if pa.types.is_timestamp(kind) and (kind.unit != "ns" or physical == "INT96"):
        return T.TimestampType() if kind.tz or physical == "INT96" else T.TimestampNTZType()
    return None


def spark_schema(file: pq.ParquetFile) -> T.StructType | None:
    """The schema Spark would read the file with."""
    said = (file.metadata.metadata or {}).get(_SPARK_SCHEMA)
    if said:
        fields = T.StructType.fromJson(json.loads(said)).fields
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    fields = []
    for i, field in enumerate(file.schema_arrow):
        if pa.types.is_nested(field.type):
            return None
        kind = _kind(field.type, file.schema.column(i).physical_type)
        if kind is None:
            return None
        fields.append(T.StructField(field.name, kind))
    return T.StructType(fields)


def described(path: str) -> tuple:
    """length, fingerprint, schema, rows and rows of each row group; nulls for a file that cannot be opened."""
    try:
        with opened(path) as source, pq.ParquetFile(source) as file:
            schema = spark_schema(file)
            text = schema.json() if schema is not None else None
            groups = [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)]
            mark = hashlib.md5(text.encode()).hexdigest() if text else None
            return source.size(), mark, text, file.metadata.num_rows, groups
    except (OSError, pa.ArrowException):
        return None, None, None, None, None


def _qualified(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths for the workers: unescaped, and with the store that a path without one belongs to."""
    root = None
    out = []
    for path in map(plain_path, paths):
        if path.startswith("/"):
            if root is None:
                at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/")
                root = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().toString().rstrip("/")
            path = path if root in ("file:", "file://") else root + path
        out.append(path)
    return out


def _sent(spark: SparkSession, paths: Sequence[str]):
    """The paths for all tasks. Functions go by value, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return spark.sparkContext.broadcast(_qualified(spark, paths))


def footers(spark: SparkSession, paths: Sequence[str], files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """One row for each path: at (its position), path, length, fingerprint and schema (JSON), rows, group_rows. Columns
    after the path are null where a file could not be opened; fingerprint and schema where Spark has to say it."""
    sent = _sent(spark, paths)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_pylist()
            rows = [(i, sent.value[i], *described(sent.value[i])) for i in at]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)],
                ["at", "path", "length", "fingerprint", "schema", "rows", "group_rows"])

    tasks = max(1, -(-len(paths) // files_per_task))
    return spark.range(0, len(paths), 1, tasks).mapInArrow(read, SCHEMA)


@dataclass
class Found:
    """Paths by schema in order of appearance, and the paths that Spark has to be asked about."""

    groups: list[tuple[list[str], T.StructType]]
    unknown: list[str]


def by_schema(spark: SparkSession, paths: Sequence[str]) -> Found:
    """Files grouped by fingerprint, in one job however schemas alternate. A task sends each schema once."""
    def first_said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set()
        for batch in batches:
            marks, texts = batch.column("fingerprint").to_pylist(), batch.column("schema").to_pylist()
            said = []
            for mark, text in zip(marks, texts):
                said.append(None if mark in known else text)
                known.add(mark)
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("fingerprint"), pa.array(said, pa.string())], ["at", "fingerprint", "schema"])

    rows = footers(spark, paths).mapInArrow(first_said, "at long, fingerprint string, schema string").collect()
    schemas = {row["fingerprint"]: row["schema"] for row in rows if row["schema"]}
    grouped: dict[str, list[str]] = {}
    unknown = []
    for row in sorted(rows, key=lambda row: row["at"]):
        path = paths[row["at"]]
        if row["fingerprint"] is None:
            unknown.append(path)
        else:
            grouped.setdefault(row["fingerprint"], []).append(path)
    return Found([(held, T.StructType.fromJson(json.loads(schemas[mark]))) for mark, held in grouped.items()], unknown)


def head_of(source, schema: pa.Schema, n: int) -> pa.Table:
    """The first ``n`` rows of a file in the columns of ``schema``. Only row groups that hold some of them are read, and
    of these only columns that are asked for."""
    with pq.ParquetFile(source, pre_buffer=False) as file:
        wanted, left = [], n
        for i in range(file.num_row_groups):
            if left <= 0:
                break
            wanted.append(i)
            left -= file.metadata.row_group(i).num_rows
        names = [name for name in schema.names if name in file.schema_arrow.names]
        table = file.read_row_groups(wanted, names).slice(0, n)
    columns = []
    for field in schema:
        if field.name not in names:
            columns.append(pa.nulls(len(table), field.type))
            continue
        column = table.column(field.name)
        columns.append(column.cast(field.type, safe=False))
    return pa.table(columns, schema=schema)


def heads(spark: SparkSession, paths: Sequence[str], schema: T.StructType, n: int, name: str) -> DataFrame:
    """The first ``n`` rows of every file as ``schema``, with the file's name in column ``name``. Files are dealt to
    tasks; what a task reads of one is the row groups that hold these rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    sent = _sent(spark, paths)
    target = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                path = sent.value[i]
                with opened(path) as source:
                    table = head_of(source, target, n)
                names = pa.array([os.path.basename(path)] * len(table), pa.string())
                yield from table.append_column(name, names).combine_chunks().to_batches()

    tasks = max(1, -(-len(paths) // FILES_PER_TASK))
    whole = T.StructType([*schema.fields, T.StructField(name, T.StringType())])
    return spark.range(0, len(paths), 1, tasks).mapInArrow(read, whole)
