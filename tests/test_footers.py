"""The table of footers, and reads planned from it."""

from __future__ import annotations

import io
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ridelake.sources import files, footers


def jobs_of(spark, work):
    """What ``work`` returns, and how many Spark jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.fixture(scope="module")
def alternating(tmp_path_factory):
    """Sixteen files whose schemas alternate between narrow and wide numbers."""
    home = tmp_path_factory.mktemp("alternating")
    for i in range(16):
        kind = pa.int32() if i % 2 else pa.int64()
        pq.write_table(pa.table({"a": pa.array(range(i + 1), kind), "s": ["x"] * (i + 1)}), home / f"m_{i:02d} [y].parquet",
                       row_group_size=4)
    return str(home)


def test_alternating_schemas_cost_one_job(spark, alternating):
    paths = files.resolve(spark, f"{alternating}/*.parquet")
    (groups, opened), jobs = jobs_of(spark, lambda: files.schemas_of(spark, paths))
    assert jobs == 1 and opened
    assert [(len(held), schema.simpleString()) for held, schema in groups] == [
        (8, "struct<a:bigint,s:string>"), (8, "struct<a:int,s:string>")]
    df, jobs = jobs_of(spark, lambda: files.scan_files(spark, paths))
    assert jobs == 1 and dict(df.dtypes) == {"a": "bigint", "s": "string"} and df.count() == sum(range(17))


def test_footers_tell_rows_and_row_groups(spark, alternating):
    paths = files.resolve(spark, f"{alternating}/*.parquet")
    rows = footers.footers(spark, paths, files_per_task=3).orderBy("at").collect()
    assert [r.rows for r in rows] == list(range(1, 17)) and rows[9].group_rows == [4, 4, 2]
    assert len({r.fingerprint for r in rows}) == 2 and all(r.length > 0 for r in rows)


def test_types_are_those_spark_reads(spark, tmp_path):
    kinds = {"b": pa.int8(), "h": pa.int16(), "i": pa.int32(), "l": pa.int64(), "f": pa.float32(), "d": pa.float64(),
             "t": pa.bool_(), "day": pa.date32(), "s": pa.string(), "m": pa.decimal128(9, 2),
             "at": pa.timestamp("us"), "utc": pa.timestamp("us", "UTC"), "none": pa.null()}
    plain = pa.table({name: pa.nulls(3, kind) for name, kind in kinds.items()})
    pq.write_table(plain, tmp_path / "plain.parquet")
    pq.write_table(plain.select(["at", "utc", "l"]), tmp_path / "old.parquet", use_deprecated_int96_timestamps=True)
    spark.sql("SELECT 1 a, array(1) b, named_struct('x', 1S) c").coalesce(1).write.parquet(str(tmp_path / "own"))
    for path in ("plain.parquet", "old.parquet", "own"):
        where = files.resolve(spark, str(tmp_path / path))
        (held, schema), = files.schemas_of(spark, where)[0]
        assert schema.simpleString() == spark.read.parquet(str(tmp_path / path)).schema.simpleString(), path


def test_what_workers_cannot_describe_is_left_to_spark(spark, tmp_path):
    pq.write_table(pa.table({"a": [[1, 2]]}), tmp_path / "nested.parquet")
    pq.write_table(pa.table({"a": [[3]], "b": [1]}), tmp_path / "nested2.parquet")
    groups, opened = files.schemas_of(spark, files.resolve(spark, f"{tmp_path}/*.parquet"))
    assert not opened and groups[0][1].simpleString() == "struct<a:array<bigint>,b:bigint>"
    assert files.read_unified(spark, f"{tmp_path}/*.parquet").count() == 2
    assert files.head_per_file(spark, files.resolve(spark, f"{tmp_path}/*.parquet"), 1).count() == 2


class Counted(io.BytesIO):
    """Bytes that are asked for."""

    taken = 0

    def read(self, size=-1):
        found = super().read(size)
        self.taken += len(found)
        return found


def test_ten_rows_read_one_row_group(spark, tmp_path):
    """Not more bytes than the first row group and the footer have; the same rows as a scan gives."""
    table = pa.table({"id": range(50_000), "text": [f"{i * 7919 % 100_003}" * 5 for i in range(50_000)]})
    pq.write_table(table, tmp_path / "large.parquet", row_group_size=5000, compression="none")
    data = (tmp_path / "large.parquet").read_bytes()
    meta = pq.read_metadata(tmp_path / "large.parquet")
    source = Counted(data)
    head = footers.head_of(pa.PythonFile(source, "r"), table.schema, 10)
    assert head.column("id").to_pylist() == list(range(10))
    assert source.taken <= meta.row_group(0).total_byte_size + 2 * 65536 < len(data) / 4
    assert footers.head_of(pa.PythonFile(Counted(data), "r"), table.schema, 7000).num_rows == 7000
    rows = files.head_per_file(spark, [str(tmp_path / "large.parquet")], 10).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(10)) and {r.source_file for r in rows} == {"large.parquet"}


def test_heads_of_drifting_files(spark, tmp_path):
    pq.write_table(pa.table({"a": pa.array([1, 2, 3], pa.int32()), "b": [1.5, 2.5, 3.5]}), tmp_path / "x.parquet")
    pq.write_table(pa.table({"a": [7], "c": ["z"]}), tmp_path / "y.parquet")
    pq.write_table(pa.table({"a": pa.array([], pa.int64())}), tmp_path / "empty.parquet")
    paths = files.resolve(spark, f"{tmp_path}/*.parquet")
    df = files.head_per_file(spark, paths, 2)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "string", "source_file": "string"}
    assert sorted((r.source_file, r.a, r.b, r.c) for r in df.collect()) == [
        ("x.parquet", 1, 1.5, None), ("x.parquet", 2, 2.5, None), ("y.parquet", 7, None, "z")]
    pq.write_table(pa.table({"a": ["text"]}), tmp_path / "z.parquet")
    mixed = files.head_per_file(spark, files.resolve(spark, f"{tmp_path}/*.parquet"), 1)
    assert sorted(r.a for r in mixed.collect()) == ["1", "7", "text"]
