"""Reading monthly Parquet files whose schemas drift, and looking at what files there are."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from ridelake.sources.footers import by_schema, heads

log = logging.getLogger(__name__)

NARROW_INTS = (ByteType, ShortType, IntegerType)
SOURCE_FILE = "source_file"


def existing(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame ``read`` opens, or None where there is no file to open."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def list_files(spark: SparkSession, directory: str, glob: str = "*.parquet") -> DataFrame:
    """``(path, length)`` of the matching files of a folder; their content is never read."""
    found = existing(lambda: (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)))
    if found is None:
        return spark.createDataFrame([], "path string, length long")
    return found.select("path", "length")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def widen_ints(df: DataFrame) -> DataFrame:
    """8/16/32-bit integers as long, every other column untouched, in one projection."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("long").alias(f.name) if isinstance(f.dataType, NARROW_INTS)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def widened(schema: StructType) -> StructType:
    return StructType([
        StructField(f.name, LongType() if isinstance(f.dataType, NARROW_INTS) else f.dataType)
        for f in schema.fields])


def union_tolerant(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name, NULL where a frame lacks a column.

    Spark finds the common type of numbers. Where one frame has text and another numbers (as when a
    file holds no value of a column and stores it as integer), text wins.
    """
    text = {f.name for frame in frames for f in frame.schema.fields if isinstance(f.dataType, StringType)}
    aligned = [frame.withColumns({
        f.name: F.col(f"`{f.name}`").cast("string") for f in frame.schema.fields
        if f.name in text and not isinstance(f.dataType, StringType)}) for frame in frames]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), aligned)


def _mergeable(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], StructType]]:
    """Split ``paths`` into groups whose footers Spark can merge, with the merged schema of each: the way for files
    whose footers only Spark can open. Each attempt is a job, and a group that does not merge is halved.
    """
    try:
        schema = spark.read.option("mergeSchema", True).parquet(*paths).schema
        return [(list(paths), schema)]
    except (Py4JJavaError, PySparkException) as error:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(error):
            raise
    middle = len(paths) // 2
    groups: list[tuple[list[str], StructType]] = []
    for part in (paths[:middle], paths[middle:]):
        for found, schema in _mergeable(spark, part):
            same = next((known for known, other in groups if other == schema), None)
            if same is None:
                groups.append((found, schema))
            else:
                same.extend(found)
    return groups


def schemas_of(spark: SparkSession, paths: Sequence[str]) -> tuple[list[tuple[list[str], StructType]], bool]:
    """Paths grouped by schema, from one job over the footers; and whether the workers could open all of them."""
    found = by_schema(spark, paths)
    if not found.unknown:
        return found.groups, True
    return [*found.groups, *_mergeable(spark, found.unknown)], False


def common_schema(schemas: Sequence[StructType]) -> StructType | None:
    """All columns in order of appearance, or None if two schemas disagree on a type."""
    types: dict[str, object] = {}
    for schema in schemas:
        for field in schema.fields:
            if types.setdefault(field.name, field.dataType) != field.dataType:
                return None
    return StructType([StructField(name, kind) for name, kind in types.items()])


def _unified(
    spark: SparkSession, groups: list[tuple[list[str], StructType]], paths: Sequence[str],
    read: Callable[[Sequence[str], StructType], DataFrame],
) -> DataFrame:
    """One frame of all groups: read at once where a common schema exists, else one frame for each schema."""
    target = common_schema([widened(found) for _, found in groups])
    if target is not None:
        return read(paths, target)
    log.info("%d file(s) in %d schemas", len(paths), len(groups))
    return union_tolerant([widen_ints(read(part, found)) for part, found in groups])


def scan_files(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """One harmonised frame over ``paths``; ``prepare`` is applied to each scan.

    With a common schema this is a single scan: Spark reads INT32 as long and fills columns that
    a file lacks. Only where types differ beyond integer width is there one scan per schema.
    """
    def read(part: Sequence[str], found: StructType) -> DataFrame:
        return prepare(spark.read.schema(found).parquet(*part))

    if schema is not None:
        return read(paths, schema)
    return _unified(spark, schemas_of(spark, paths)[0], paths, read)


def resolve(spark: SparkSession, glob: str) -> list[str]:
    """Paths a glob stands for, without a job; ``FileNotFoundError`` if there are none."""
    found = existing(lambda: spark.read.format("binaryFile").load(glob))
    # inputFiles() returns percent-encoded URIs.
    paths = sorted(literal_path(unquote(uri)) for uri in found.inputFiles()) if found is not None else []
    if not paths:
        raise FileNotFoundError(f"no file matches {glob}")
    return paths


def literal_path(path: str) -> str:
    """A path for readers, which take their paths as globs."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def read_unified(spark: SparkSession, glob: str, schema: StructType | None = None) -> DataFrame:
    """All files of a glob as one frame: integers as long, missing columns NULL."""
    return scan_files(spark, resolve(spark, glob), schema)


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the name of the file each row comes from (only directly above a scan)."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return df.select("*", F.url_decode(encoded).alias(SOURCE_FILE))


def head_per_file(spark: SparkSession, paths: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows of every file with the file's name; an empty file adds none.

    Tasks open the files and read only the row groups that hold these rows. Files that only Spark can open are
    scanned, and the position of a row in its file decides.
    """
    groups, opened = schemas_of(spark, paths)
    if opened:
        return _unified(spark, groups, paths, lambda part, found: heads(spark, part, found, n, SOURCE_FILE))

    def scanned(part: Sequence[str], found: StructType) -> DataFrame:
        return with_source_file(spark.read.schema(found).parquet(*part).where(F.col("_metadata.row_index") < n))

    return _unified(spark, groups, paths, scanned)


def expected_files(
    spark: SparkSession, dataset: str, years: Sequence[int], months: Sequence[str]
) -> DataFrame:
    """``(name)`` of the monthly files of a dataset, one per year and month."""
    every_year = spark.createDataFrame([(str(year),) for year in years], "year string")
    return every_year.select(F.explode(F.array(*[
        F.concat(F.lit(f"{dataset}_"), F.col("year"), F.lit(f"-{month}.parquet"))
        for month in months])).alias("name"))


def missing_files(expected: DataFrame, listed: DataFrame) -> DataFrame:
    """Expected names that are not listed."""
    return expected.join(listed, "name", "left_anti")


def available_files(expected: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed files that were expected; the missing ones are reported and skipped."""
    absent = [row["name"] for row in missing_files(expected, listed).orderBy("name").collect()]
    if absent:
        log.warning("%d expected file(s) missing: %s", len(absent), ", ".join(absent))
    return listed.join(expected, "name", "left_semi")


def profile(df: DataFrame) -> DataFrame:
    """``(column, type, rows)`` in column order; the row count needs no column to be read."""
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col("rows").alias("rows"))
        for f in df.schema.fields])))
