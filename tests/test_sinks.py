from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ridelake_checks.compare import spark_rows
from ridelake.operators.enrich import enrich_trips, to_facts
from ridelake.operators.marts import MARTS, build_marts
from ridelake.session import INITIAL_PARTITIONS, settings
from ridelake.sinks import parquet, warehouse
from ridelake.sources import files, landing


def parts(path, pattern="*.parquet"):
    return glob.glob(os.path.join(path, pattern))


@pytest.fixture(scope="module")
def facts(trips):
    days = [{"pickup_datetime": dt.datetime(2024, 1, day, 9)} for day in (1, 2, 3)]
    return to_facts(enrich_trips(trips(*days, *days, {"PULocationID": None})))


def test_facts_roundtrip_and_overwrite(spark, facts, tmp_path):
    path = str(tmp_path / "facts")
    parquet.write_facts(facts, path)
    parquet.write_facts(facts.where("date_trajet > '2024-01-01'"), path)
    parquet.write_facts(facts, path)
    assert sorted(os.path.basename(p) for p in parts(path, "date_trajet=*")) == [
        f"date_trajet=2024-01-0{d}" for d in (1, 2, 3, 7)]
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["date_trajet"] == "date"
    assert spark_rows(back.select(*facts.columns)) == spark_rows(facts)
    pruned = back.where("date_trajet = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_trajet" in pruned


def test_overwrite_replaces_everything_even_in_a_dynamic_session(spark, facts, tmp_path):
    path = str(tmp_path / "facts")
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        parquet.write_facts(facts, path)
        parquet.write_facts(facts.where("date_trajet = '2024-01-01'"), path)
    assert len(parts(path, "date_trajet=*")) == 1


def test_a_hot_date_is_split_over_tasks_and_small_dates_are_not(spark, facts, tmp_path):
    """One date with nearly all rows must not be written by one task."""
    path = str(tmp_path / "facts")
    copies = F.when(F.col("date_trajet") == "2024-01-01", 60000).otherwise(2)
    skewed = (facts.withColumn("n", F.explode(F.sequence(F.lit(1), copies)))
              .withColumn("trip_miles", F.rand(7)).drop("n"))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k",
                          INITIAL_PARTITIONS: "200"}):
        parquet.write_facts(skewed.repartition(8), path)
    assert len(parts(f"{path}/date_trajet=2024-01-01")) > 1
    assert all(len(parts(f"{path}/date_trajet=2024-01-0{d}")) == 1 for d in (2, 3, 7))
    assert spark.read.parquet(path).count() == skewed.count()


def test_marts_are_one_sorted_file_each(spark, facts, tmp_path):
    paths = parquet.write_marts(build_marts(facts), str(tmp_path))
    assert list(paths) == list(MARTS)
    for name, path in paths.items():
        assert len(parts(path)) == 1, name
        assert spark_rows(spark.read.parquet(path)) == spark_rows(build_marts(facts)[name])
    hours = [row.heure for row in spark.read.parquet(paths["trajets_par_heure"]).collect()]
    assert hours == sorted(hours)


def test_csv_export(spark, facts, tmp_path):
    parquet.export_csv(facts, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == facts.columns and back.count() == facts.count()


def test_load_tables_skips_absent_and_survives_broken_ones(spark, facts, tmp_path):
    base = str(tmp_path)
    parquet.write_facts(facts, f"{base}/trajets_nettoyes")
    built = build_marts(facts)
    parquet.write_marts({name: built[name] for name in ("kpi_globaux", "trajets_par_heure")}, base)
    os.makedirs(f"{base}/kpi_par_plateforme")
    os.makedirs(f"{base}/revenu_par_zone_depart")
    with open(f"{base}/revenu_par_zone_depart/part.parquet", "w") as broken:
        broken.write("not parquet")
    for _ in range(2):
        loaded, failed = warehouse.load_tables(spark, base, "load_db")
        assert loaded == {"trajets_nettoyes": 7, "kpi_globaux": 1, "trajets_par_heure": 2}
        assert failed == ["revenu_par_zone_depart"]
    table = spark.table("load_db.trajets_nettoyes")
    assert dict(table.dtypes)["date_trajet"] == "date"
    counts = warehouse.table_row_counts({name: spark.table(f"load_db.{name}") for name in loaded})
    assert {row["table"]: row["rows"] for row in counts.collect()} == loaded


def test_a_load_that_dies_leaves_the_table_readable(spark, facts, tmp_path, monkeypatch):
    def write(rows):
        base = warehouse.new_version(str(tmp_path))
        parquet.write_facts(rows, f"{base}/trajets_nettoyes")
        return base

    def rows():
        return spark.table("swap_db.trajets_nettoyes").count()

    spark.sql("CREATE SCHEMA swap_db")
    spark.sql("CREATE TABLE swap_db.trajets_nettoyes (id LONG) USING parquet")  # of an earlier kind of load
    first, second = write(facts), write(facts.where("date_trajet = '2024-01-01'"))
    assert warehouse.load_tables(spark, first, "swap_db") == ({"trajets_nettoyes": 7}, [])
    assert rows() == 7

    def dies(*_):
        raise RuntimeError("lost")
    point = warehouse._point
    monkeypatch.setattr(warehouse, "_point", dies)  # before the change
    assert warehouse.load_tables(spark, second, "swap_db") == ({}, ["trajets_nettoyes"])
    assert rows() == 7
    monkeypatch.setattr(warehouse, "_point", lambda *where: (point(*where), dies()))  # right after it
    assert warehouse.load_tables(spark, second, "swap_db") == ({}, ["trajets_nettoyes"])
    assert rows() == 2
    monkeypatch.setattr(warehouse, "_point", point)
    assert warehouse.load_tables(spark, second, "swap_db") == ({"trajets_nettoyes": 2}, [])
    stored = spark.table("swap_db.trajets_nettoyes")
    assert "PartitionFilters: [isnotnull(date_trajet" in stored.where(
        "date_trajet = '2024-01-01'")._jdf.queryExecution().executedPlan().toString()

    assert len(warehouse.vacuum(spark, "swap_db")) == 3 and warehouse.vacuum(spark, "swap_db") == []
    assert rows() == 2 and len(parts(f"{second}/trajets_nettoyes/*")) > 0
    assert not os.path.exists(f"{first}/trajets_nettoyes")  # no view reads it; the other folder is still read


def test_filters_on_either_zone_skip_row_groups(spark, tmp_path):
    """Row groups that a filter on one zone must read, by the least and greatest zone in their footers."""
    trips = spark.range(200_000).selectExpr(
        "date'2024-01-01' AS day", "pmod(xxhash64(id), 256) AS pickup", "pmod(xxhash64(id, 1), 256) AS dropoff", "id")
    read = {}
    for name, cluster in {"both": [parquet.interleaved("pickup", "dropoff")], "one": ["pickup", "dropoff"]}.items():
        path = str(tmp_path / name)
        (parquet.spread(trips, "day", *cluster).write.option("parquet.block.size", 32 * 1024)
         .option("parquet.block.size.row.check.min", 100).option("parquet.page.size.row.check.min", 100).parquet(path))
        groups = [meta.row_group(i) for part in parts(path) for meta in [pq.ParquetFile(part).metadata]
                  for i in range(meta.num_row_groups)]
        assert len(groups) >= 32
        for at, zone in ((1, "pickup"), (2, "dropoff")):
            hits = [sum(g.column(at).statistics.min <= z <= g.column(at).statistics.max for g in groups)
                    for z in range(0, 256, 15)]
            read[name, zone] = sum(hits) / len(hits) / len(groups)
    assert read["both", "pickup"] < 0.35 and read["both", "dropoff"] < 0.35
    assert read["one", "dropoff"] > 0.9  # what sorting by pickup first gives


def test_interleaved_order_by_hand(spark):
    rows = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (3, 5), (None, 1), (-4, 70_000)], "a long, b long")
    def expected(a, b):
        a, b = (min(max(x or 0, 0), 65_535) for x in (a, b))
        return sum((a >> i & 1) << 2 * i + 1 | (b >> i & 1) << 2 * i for i in range(16))
    for row in rows.withColumn("at", parquet.interleaved("a", "b")).collect():
        assert row.at == expected(row.a, row.b)


def raw_file(spark, folder, name, sql):
    os.makedirs(folder, exist_ok=True)
    spark.sql(sql).toPandas().to_parquet(f"{folder}/{name}.parquet", index=False)


def actions(df):
    return {row["name"].removesuffix(".parquet"): row.action for row in df.collect()}


def test_landing_is_idempotent_and_replaces_what_changed(spark, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    raw_file(spark, source, "t_2024-01", "SELECT id a, 1.5D fee FROM range(10)")
    raw_file(spark, source, "t_2024-02", "SELECT cast(id AS int) a FROM range(20)")
    assert actions(landing.land_raw(spark, source, lake)) == {"t_2024-01": "new", "t_2024-02": "new"}
    lake_rows = landing.read_lake(spark, lake)
    assert sorted(lake_rows.columns) == ["a", "fee"] and lake_rows.count() == 30
    before = sorted(glob.glob(f"{lake}/**/*.parquet", recursive=True))

    assert actions(landing.land_raw(spark, source, lake)) == {"t_2024-01": "skip", "t_2024-02": "skip"}
    assert sorted(glob.glob(f"{lake}/**/*.parquet", recursive=True)) == before

    raw_file(spark, source, "t_2024-02", "SELECT id + 100 a, 'x' extra FROM range(2000)")
    raw_file(spark, source, "t_2024-03", "SELECT id a FROM range(5)")
    assert actions(landing.land_raw(spark, source, lake)) == {
        "t_2024-01": "skip", "t_2024-02": "replace", "t_2024-03": "new"}
    lake_rows = landing.read_lake(spark, lake)
    assert lake_rows.count() == 10 + 2000 + 5
    assert sorted(lake_rows.columns) == ["a", "extra", "fee"]
    assert set(actions(landing.land_raw(spark, source, lake)).values()) == {"skip"}


def test_a_replacement_without_rows_leaves_no_old_rows(spark, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(10)")
    raw_file(spark, source, "t_2", "SELECT id a FROM range(3)")
    landing.land_raw(spark, source, lake)
    raw_file(spark, source, "t_1", "SELECT id a FROM range(0)")
    assert actions(landing.land_raw(spark, source, lake)) == {"t_1": "replace", "t_2": "skip"}
    assert landing.read_lake(spark, lake).count() == 3


def test_an_interrupted_landing_is_done_again(spark, tmp_path, monkeypatch):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(10)")
    with monkeypatch.context() as patch:
        patch.setattr(landing, "MANIFEST", "no/such:/\0place")
        with pytest.raises(Exception):
            landing.land_raw(spark, source, lake)
    assert actions(landing.land_raw(spark, source, lake)) == {"t_1": "new"}
    assert landing.read_lake(spark, lake).count() == 10


def test_an_interrupted_replacement_changes_nothing_and_is_done_again(spark, tmp_path, monkeypatch):
    """The new version is written, the manifest is not, and then the source returns to its old file."""
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(10)")
    raw_file(spark, source, "t_2", "SELECT id a FROM range(3)")
    landing.land_raw(spark, source, lake)
    raw_file(spark, source, "t_1", "SELECT id a FROM range(500)")
    with monkeypatch.context() as patch:
        patch.setattr(landing.F, "current_timestamp", lambda: landing.F.raise_error(landing.F.lit("interrupted")))
        with pytest.raises(Exception):
            landing.land_raw(spark, source, lake)
    assert landing.read_lake(spark, lake).count() == 13
    raw_file(spark, source, "t_1", "SELECT id a FROM range(10)")
    assert actions(landing.land_raw(spark, source, lake)) == {"t_1": "skip", "t_2": "skip"}
    assert landing.read_lake(spark, lake).count() == 13
    raw_file(spark, source, "t_1", "SELECT id a FROM range(500)")
    assert actions(landing.land_raw(spark, source, lake)) == {"t_1": "replace", "t_2": "skip"}
    assert landing.read_lake(spark, lake).count() == 503


def test_a_partition_removed_by_hand_lands_again(spark, tmp_path):
    import shutil
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(10)")
    raw_file(spark, source, "t_2", "SELECT id a FROM range(3)")
    landing.land_raw(spark, source, lake)
    shutil.rmtree(glob.glob(f"{lake}/version=*/source_file=t_1.parquet")[0])
    assert actions(landing.land_raw(spark, source, lake)) == {"t_1": "new", "t_2": "skip"}
    assert landing.read_lake(spark, lake).count() == 13


def test_a_part_removed_or_cut_by_hand_lands_again(spark, tmp_path):
    """The manifest knows each part file with its length; a listing shows what is gone."""
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    for i in (1, 2, 3):
        raw_file(spark, source, f"t_{i}", f"SELECT id a FROM range({i * 10})")
    landing.land_raw(spark, source, lake)
    os.remove(glob.glob(f"{lake}/version=*/source_file=t_1.parquet/*.parquet")[0])
    cut = glob.glob(f"{lake}/version=*/source_file=t_2.parquet/*.parquet")[0]
    with open(cut, "r+b") as part:
        part.truncate(os.path.getsize(cut) - 1)
    assert actions(landing.land_raw(spark, source, lake)) == {"t_1": "new", "t_2": "new", "t_3": "skip"}
    assert landing.read_lake(spark, lake).count() == 60


def test_a_landing_opens_nothing_of_the_old_lake(spark, tmp_path):
    """Old parts are replaced by bytes of the same length that no Parquet reader could open."""
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    for i in (1, 2):
        raw_file(spark, source, f"t_{i}", f"SELECT id a FROM range({i * 10})")
    landing.land_raw(spark, source, lake)
    for part in glob.glob(f"{lake}/version=*/source_file=*/*.parquet"):
        size = os.path.getsize(part)
        with open(part, "wb") as broken:
            broken.write(b"x" * size)
    raw_file(spark, source, "t_3", "SELECT id a FROM range(5)")
    assert actions(landing.land_raw(spark, source, lake)) == {"t_1": "skip", "t_2": "skip", "t_3": "new"}


def test_two_racing_landings_both_end_complete(spark, tmp_path, monkeypatch):
    """While the first has written and not committed, a second one lands the same files and one more."""
    source, other, lake = str(tmp_path / "in"), str(tmp_path / "other"), str(tmp_path / "lake")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(10)")
    raw_file(spark, source, "t_2", "SELECT id a FROM range(20)")
    raw_file(spark, other, "t_1", "SELECT id a FROM range(10)")
    raw_file(spark, other, "t_3", "SELECT id a FROM range(5)")
    commit, raced = landing.try_commit, []

    def late(*args):
        if not raced:
            raced.append(True)
            landing.land_raw(spark, other, lake)
        return commit(*args)

    monkeypatch.setattr(landing, "try_commit", late)
    landing.land_raw(spark, source, lake)
    rows = {row["name"]: row["number"] for row in landing.manifest(spark, lake).collect()}
    assert rows == {"t_1.parquet": 1, "t_2.parquet": 2, "t_3.parquet": 1}
    assert landing.read_lake(spark, lake).count() == 35
    assert len(glob.glob(f"{lake}/version=*/source_file=t_1.parquet")) == 1  # the loser's copy is gone
    assert set(actions(landing.land_raw(spark, source, lake)).values()) == {"skip"}


def test_a_commit_number_is_taken_once(spark, tmp_path):
    lake = str(tmp_path)
    assert landing.last_commit(spark, lake) == 0
    assert [landing.try_commit(spark, lake, n, "x") for n in (1, 1, 2)] == [True, False, True]
    assert landing.last_commit(spark, lake) == 2


def test_vacuum_removes_only_old_versions_nobody_names(spark, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(10)")
    landing.land_raw(spark, source, lake)
    os.makedirs(f"{lake}/version=vdead/source_file=t_9.parquet")
    assert landing.vacuum(spark, lake) == []
    assert landing.vacuum(spark, lake, older_than_hours=-1) == ["vdead"]
    assert landing.read_lake(spark, lake).count() == 10


def test_names_with_special_characters(spark, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    names = ["t=1", "t 2", "t%203", "t+4"]
    for i, name in enumerate(names):
        raw_file(spark, source, name, f"SELECT id a FROM range({i + 5})")
    landing.land_raw(spark, source, lake)
    assert set(actions(landing.land_raw(spark, source, lake)).values()) == {"skip"}
    raw_file(spark, source, "t=1", "SELECT id a FROM range(0)")
    raw_file(spark, source, "t 2", "SELECT id a FROM range(100)")
    found = actions(landing.land_raw(spark, source, lake))
    assert {n: found[n] for n in names} == {"t=1": "replace", "t 2": "replace", "t%203": "skip", "t+4": "skip"}
    assert landing.read_lake(spark, lake).count() == 0 + 100 + 7 + 8


def test_samples_are_written_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "samples")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(30)")
    raw_file(spark, source, "t_2", "SELECT id a FROM range(4)")
    paths = files.resolve(spark, f"{source}/*.parquet")

    def write(chosen):
        return sorted(row.source_file for row in
                      landing.write_sample(files.head_per_file(spark, chosen), out).collect())

    assert write(paths[:1]) == ["t_1.parquet"]
    assert write(paths) == ["t_2.parquet"]
    assert write(paths) == []
    assert spark.read.parquet(out).count() == 14


def test_a_half_written_sample_is_made_again(spark, tmp_path):
    """Rows without an entry in the ledger do not count, and are replaced."""
    source, out = str(tmp_path / "in"), str(tmp_path / "samples")
    raw_file(spark, source, "t_1", "SELECT id a FROM range(30)")
    raw_file(spark, source, "t_2", "SELECT id a FROM range(4)")
    paths = files.resolve(spark, f"{source}/*.parquet")
    landing.write_sample(files.head_per_file(spark, paths[:1]), out)
    spark.sql("SELECT id a, 't_2.parquet' source_file FROM range(2)").write.mode("append").partitionBy(
        "source_file").parquet(out)
    assert [r.source_file for r in landing.write_sample(files.head_per_file(spark, paths), out).collect()] == ["t_2.parquet"]
    assert dict(spark.read.parquet(out).groupBy("source_file").count().collect()) == {"t_1.parquet": 10, "t_2.parquet": 4}


def test_landing_actions(spark):
    source = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, length long")
    lake = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4)], "name string, length long")
    found = {row["name"]: row["action"] for row in landing.landing_actions(source, lake).collect()}
    assert found == {"a": "skip", "b": "replace", "c": "new"}
