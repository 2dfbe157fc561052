from __future__ import annotations

import datetime as dt

import pytest

from ridelake_checks.compare import spark_rows
from ridelake import session
from ridelake.operators.clean import clean_trips
from ridelake.operators.enrich import enrich_trips, to_facts
from ridelake.operators.marts import MARTS, build_marts
from ridelake.operators.quality import require_partition_filter
from ridelake.plans import pipeline, reports
from ridelake.sources.files import existing


@pytest.fixture(scope="module")
def months(spark, trips, tmp_path_factory):
    """Two monthly files; a trip of the first is repeated in the second, whose zones are narrow."""
    home = tmp_path_factory.mktemp("months")
    january = trips({}, {"tips": None}, {"trip_miles": 0.0}, {"hvfhs_license_num": "HV0005"}).toPandas()
    later = {"pickup_datetime": dt.datetime(2024, 2, 1, 8), "dropoff_datetime": dt.datetime(2024, 2, 1, 9)}
    february = trips({}, later, {**later, "PULocationID": 2}, {**later, "trip_time": 5}).toPandas()
    february = february.astype({"PULocationID": "int32", "DOLocationID": "int32"})
    for name, frame in {"fhvhv_tripdata_2024-01": january, "fhvhv_tripdata_2024-02": february}.items():
        for column in ("request_datetime", "pickup_datetime", "dropoff_datetime"):
            frame[column] = frame[column].astype("datetime64[us]")
        frame["airport_fee"] = frame["airport_fee"].astype("float64")
        frame.to_parquet(home / f"{name}.parquet", index=False)
    (home / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,Queens,Astoria,x\n2,Bronx,Fordham,x\n")
    return str(home)


def test_one_run_gives_nine_tables_and_a_second_changes_nothing(spark, months, tmp_path):
    where = [str(tmp_path / name) for name in ("lake", "out")]
    first = pipeline.run(spark, months, *where, "pipe_db", f"{months}/zones.csv")
    assert first.actions == {"new": 2}
    assert (first.rows_in, first.rows_kept) == (8, 5)
    assert first.tables == {
        "trajets_nettoyes": 5, "kpi_globaux": 1, "kpi_par_plateforme": 2, "trajets_par_heure": 3,
        "trajets_par_jour_semaine": 3, "trajets_par_annee_mois": 3, "revenu_par_zone_depart": 3,
        "fact_trips": 5, "dim_zones": 2}
    tables = {name: spark_rows(spark.table(f"pipe_db.{name}")) for name in first.tables}

    second = pipeline.run(spark, months, *where, "pipe_db", f"{months}/zones.csv")
    assert second.actions == {"skip": 2} and second.tables == first.tables
    assert {name: spark_rows(spark.table(f"pipe_db.{name}")) for name in second.tables} == tables

    star, dims = spark.table("pipe_db.fact_trips"), spark.table("pipe_db.dim_zones")
    period = ("2024-01-01", "2024-03-31")
    quality = require_partition_filter(reports.report_quality(star, *period)).first()
    assert tuple(quality) == (5, 0, 0, 0, 0, 0)
    top = require_partition_filter(reports.report_top_zones(star, dims, *period)).collect()
    assert [(row.zone, row.nb_courses) for row in top] == [("Astoria", 4), ("Fordham", 1)]


def test_both_ways_of_writing_facts_agree(spark, trips, tmp_path):
    raw = trips({}, {}, {"tips": 1.0}, {"trip_miles": 0.0})
    facts = to_facts(enrich_trips(clean_trips(raw)))
    for keep in (False, True):
        out = str(tmp_path / str(keep))
        paths, staged = pipeline.transform(spark, raw, out, keep_enriched=keep)
        assert list(paths) == ["trajets_nettoyes", *MARTS]
        assert (staged is not None) == keep
        assert spark_rows(spark.read.parquet(paths["trajets_nettoyes"]).select(*facts.columns)) == spark_rows(facts)
        for name, mart in build_marts(facts).items():
            assert spark_rows(spark.read.parquet(paths[name])) == spark_rows(mart), name
    assert spark.read.parquet(staged).count() == 2
    session.discard(spark, staged)
    assert existing(lambda: spark.read.parquet(staged)) is None
    with pytest.raises(ValueError):
        session.discard(spark, str(tmp_path))


def leftovers(spark):
    import os
    root = session.checkpoint_root(spark).removeprefix("file:")
    return [name for name in os.listdir(root) if "enriched" in name or "rollup" in name or "actions" in name]


def test_without_readable_zones_the_trips_are_loaded_and_missing_months_told(spark, months, tmp_path):
    outcome = pipeline.run(
        spark, months, str(tmp_path / "lake"), str(tmp_path / "out"), "pipe_db7", dataset="fhvhv_tripdata",
        years=[2024], months=["01", "02", "03"])
    assert len(outcome.tables) == 8 and outcome.tables["fact_trips"] == 5
    assert outcome.missing == ["fhvhv_tripdata_2024-03.parquet"] and not outcome.failed
    outcome = pipeline.run(
        spark, months, str(tmp_path / "lake"), str(tmp_path / "out"), "pipe_db7", str(tmp_path / "none.csv"))
    assert outcome.failed == ["dim_zones"] and outcome.tables["fact_trips"] == 5
    assert leftovers(spark) == []


def test_a_failed_run_leaves_nothing_in_the_work_folder(spark, months, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("broken")
    for name in ("build_marts", "load_tables"):
        with monkeypatch.context() as patch:
            patch.setattr(pipeline, name, broken)
            with pytest.raises(RuntimeError):
                pipeline.run(spark, months, str(tmp_path / "lake"), str(tmp_path / "out"), "pipe_db8")
        assert leftovers(spark) == []


def test_sizes_follow_the_decoded_input_without_a_ceiling(spark, months):
    tib = 2**40
    assert session.shuffle_partitions(0, 8) == 8
    assert [session.shuffle_partitions(n * tib, 200) for n in (1, 10, 100, 1024)] == [4096, 40_960, 409_600, 4_194_304]
    assert session.shuffle_partitions(100 * tib, 200, most=50_000) == 50_000
    assert [session.write_bytes(n * tib) >> 20 for n in (1, 10, 100, 1024)] == [128, 128, 1024, 1024]
    assert session.split_bytes(100 * tib) == 549755814 and session.split_bytes(2**60) == 2**30
    raw = spark.read.parquet(f"{months}/*.parquet")
    assert 0 < session.input_bytes(raw) < 10**6
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    with session.sized_for(spark, 100 * tib):
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "409600"
        assert spark.conf.get(session.ADVISORY_BYTES) == str(2**30)
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) == before


def test_work_folder_is_the_one_the_session_names(spark):
    root = session.checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.work_path(spark, "x").startswith(f"{root}/ridelake-x-")
    assert session.work_path(spark, "x") != session.work_path(spark, "x")
    with pytest.raises(RuntimeError), session.work_table(spark.range(3), "block") as table:
        path = table.inputFiles()[0]
        assert table.count() == 3
        raise RuntimeError
    assert existing(lambda: spark.read.parquet(path.rsplit("/", 1)[0])) is None
