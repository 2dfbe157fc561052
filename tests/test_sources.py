from __future__ import annotations

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from ridelake.sources import files, landing, tables
from ridelake_checks import loads
from ridelake_checks.trip_view import raw_trips


@pytest.fixture(scope="module")
def drifting(spark, tmp_path_factory):
    """Three monthly files: narrow zones, wide zones without the fee, and a new column."""
    home = tmp_path_factory.mktemp("drift")
    months = {
        "t_2024-01": "SELECT cast(id AS int) PULocationID, cast(id AS short) code, id * 0.5D airport_fee, cast(id AS string) s FROM range(20)",
        "t_2024-02": "SELECT id PULocationID, cast(id AS byte) code, cast(id AS string) s FROM range(15)",
        "t_2024-03 [x]": "SELECT cast(id AS int) PULocationID, id * 0.5D airport_fee, id extra FROM range(5)",
        "t_2024-04": "SELECT id PULocationID FROM range(0)",
    }
    for name, sql in months.items():
        spark.sql(sql).toPandas().to_parquet(home / f"{name}.parquet", index=False)
    import pyarrow as pa
    import pyarrow.parquet as pq
    for name, narrow in {"t_2024-01": {"PULocationID": pa.int32(), "code": pa.int16()},
                         "t_2024-02": {"code": pa.int8()}, "t_2024-03 [x]": {"PULocationID": pa.int32()}}.items():
        table = pq.read_table(home / f"{name}.parquet")
        for column, kind in narrow.items():
            at = table.schema.get_field_index(column)
            table = table.set_column(at, column, table[column].cast(kind))
        pq.write_table(table, home / f"{name}.parquet")
    return str(home)


def test_unified_reads_drifting_files_in_one_scan(spark, drifting):
    df = files.read_unified(spark, f"{drifting}/*.parquet")
    assert dict(df.dtypes) == {"PULocationID": "bigint", "code": "bigint", "airport_fee": "double",
                               "s": "string", "extra": "bigint"}
    assert df.count() == 40
    assert df.where("airport_fee IS NULL").count() == 15
    assert df.where("s IS NULL AND code IS NULL").count() == 5
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_unified_with_schema_and_without_files(spark, drifting):
    df = files.read_unified(spark, f"{drifting}/t_2024-0[12].parquet", spark.range(1).selectExpr("id PULocationID").schema)
    assert df.columns == ["PULocationID"] and df.count() == 35
    for glob in (f"{drifting}/none*.parquet", f"{drifting}/nowhere/*.parquet"):
        with pytest.raises(FileNotFoundError):
            files.read_unified(spark, glob)


def test_types_that_differ_beyond_width_are_stacked(spark, tmp_path):
    spark.sql("SELECT id v, 'a' s FROM range(3)").write.parquet(str(tmp_path / "a"))
    spark.sql("SELECT id * 0.5D v FROM range(3)").write.parquet(str(tmp_path / "b"))
    df = files.read_unified(spark, f"{tmp_path}/*/*.parquet")
    assert dict(df.dtypes) == {"v": "double", "s": "string"}
    assert sorted(row.v for row in df.collect()) == [0.0, 0.0, 0.5, 1.0, 1.0, 2.0]


def test_a_column_without_values_may_be_of_any_type(spark, tmp_path):
    """An all-NULL column is often stored as integer."""
    spark.sql("SELECT 1L id, cast(NULL AS int) flag").write.parquet(str(tmp_path / "a"))
    spark.sql("SELECT 2L id, 'Y' flag").write.parquet(str(tmp_path / "b"))
    df = files.read_unified(spark, f"{tmp_path}/*/*.parquet")
    assert sorted((row.id, row.flag) for row in df.collect()) == [(1, None), (2, "Y")]


def test_widen_and_union(spark):
    df = spark.sql("SELECT 1Y a, 2S b, 3 c, 4L d, 5.0D e, 'x' f, true g")
    wide = files.widen_ints(df)
    assert [kind for _, kind in wide.dtypes] == ["bigint"] * 4 + ["double", "string", "boolean"]
    stacked = files.union_tolerant([wide, spark.sql("SELECT 'y' f, 9L z")])
    assert stacked.columns == ["a", "b", "c", "d", "e", "f", "g", "z"]
    assert stacked.where("f = 'y'").first().a is None


def test_head_per_file(spark, drifting):
    paths = files.resolve(spark, f"{drifting}/*.parquet")
    rows = files.head_per_file(spark, paths, 10).collect()
    by_file = {}
    for row in rows:
        by_file.setdefault(row.source_file, []).append(row.PULocationID)
    assert {name: sorted(ids) for name, ids in by_file.items() if "x" not in name} == {
        "t_2024-01.parquet": list(range(10)), "t_2024-02.parquet": list(range(10))}
    assert len(rows) == 25


def test_listing(spark, drifting, tmp_path):
    listed = {row.path.rsplit("/", 1)[1]: row.length for row in files.list_files(spark, drifting).collect()}
    assert set(listed) == {"t_2024-01.parquet", "t_2024-02.parquet", "t_2024-03 [x].parquet", "t_2024-04.parquet"}
    assert all(length > 0 for length in listed.values())
    assert files.list_files(spark, drifting, "*-02.parquet").count() == 1
    assert files.list_files(spark, drifting, "*.csv").count() == 0
    assert files.list_files(spark, str(tmp_path / "absent")).count() == 0


def test_periods(spark):
    expected = files.expected_files(spark, "fhvhv_tripdata", [2023, 2024], ["01", "12"])
    names = sorted(row["name"] for row in expected.collect())
    assert names == [f"fhvhv_tripdata_{y}-{m}.parquet" for y in (2023, 2024) for m in ("01", "12")]
    listed = spark.createDataFrame([(names[0],), ("other.parquet",)], "name string")
    assert sorted(row["name"] for row in files.missing_files(expected, listed).collect()) == names[1:]
    assert [row["name"] for row in files.available_files(expected, listed).collect()] == names[:1]


def test_profile(spark, drifting):
    found = [tuple(row) for row in files.profile(spark.read.parquet(f"{drifting}/t_2024-02.parquet")).collect()]
    assert found == [("PULocationID", "bigint", 15), ("code", "tinyint", 15), ("s", "string", 15)]


def test_zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"Zone","LocationID","Borough","service_zone"\n"Astoria",7,"Queens","Boro Zone"\n'
                    '"N/A",264,"Unknown","N/A"\n"Outside of NYC",265,"N/A","N/A"\n')
    rows = {row.zone_id: (row.arrondissement, row.zone_nom) for row in tables.read_zones(spark, str(path)).collect()}
    assert rows == {7: ("Queens", "Astoria"), 264: ("Unknown", None), 265: (None, "Outside of NYC")}
    assert tables.read_zones(spark, str(tmp_path / "no.csv")) is None
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    assert tables.read_zones(spark, str(tmp_path / "bad.csv")) is None


def test_facts_come_back_with_date_and_french_day(spark, trips, tmp_path):
    from ridelake.operators.enrich import enrich_trips, to_facts
    from ridelake.sinks.parquet import write_facts

    write_facts(to_facts(enrich_trips(trips({}))), str(tmp_path / "facts"))
    row = tables.read_facts(spark, str(tmp_path / "facts")).first()
    assert (row.date_trajet, row.nom_jour_fr) == (dt.date(2024, 1, 7), "Dimanche")


def test_all_months_of_the_trips_are_landed(spark, monkeypatch):
    """What the lake holds after the last of the query's landings is every trip, whatever its year."""
    sf, land, lakes = "/root/testdata/sf0.001", landing.land_raw, []
    month = F.date_format("pickup_datetime", "yyyy-MM")

    def seen(spark, source, lake):
        done = land(spark, source, lake)
        lakes.append(dict(landing.read_lake(spark, lake).groupBy(month).count().collect()))
        return done

    monkeypatch.setattr(landing, "land_raw", seen)
    loads.landed_rows(spark, sf)
    expected = dict(raw_trips(spark, sf).where("pickup_datetime IS NOT NULL").groupBy(month).count().collect())
    assert len(lakes) == 3 and lakes[0] == lakes[2] == expected
    assert {at for at in expected if lakes[1][at] != expected[at]} == {"1997-06"}


def test_only_the_changed_month_is_written_again(spark, monkeypatch):
    """The files of other months stay as they are between the query's landings."""
    land, seen = landing.land_raw, []

    def watched(spark, source, lake):
        seen.append({f.name: f.stat().st_ino for f in pathlib.Path(source).glob("*.parquet")})
        return land(spark, source, lake)

    monkeypatch.setattr(landing, "land_raw", watched)
    loads.landed_rows(spark, "/root/testdata/sf0.001")
    for before, after in zip(seen, seen[1:]):
        assert before.keys() == after.keys()
        assert [name for name in before if before[name] != after[name]] == ["fhvhv_tripdata_1997-06.parquet"]
