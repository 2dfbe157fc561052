"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

from ridelake_checks.registry import QUERIES, facts
from ridelake_checks.trip_view import raw_trips
from ridelake.operators import clean, enrich, filters, marts, quality, star
from ridelake import session
from ridelake.plans import explore
from ridelake.session import settings, work_path
from ridelake.sinks import warehouse

SF = "/root/testdata/sf0.001"
WRITES = {"facts_roundtrip", "landed_rows", "raw_unified_drift", "zones_from_csv", "csv_roundtrip", "loaded_tables",
          "sample_written", "empty_signal", "stored_preview"}
LAZY = [name for name in QUERIES if name not in WRITES and not name.startswith(("rollup_", "stored_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark):
    path = work_path(spark, "test-raw")
    raw_trips(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_single_task_sort(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "MapInPandas", "Scan ExistingRDD[_", "CollectLimit"):
        assert bad not in text, bad


def test_rules_reach_the_scan_and_run_before_the_distinct(landed):
    with settings(landed.sparkSession, {"spark.sql.maxMetadataStringLength": "4000"}):
        text = plan(clean.clean_trips(landed))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for wanted in ("IsNotNull(pickup_datetime)", "GreaterThanOrEqual(trip_time,60)",
                   "LessThanOrEqual(trip_time,18000)", "GreaterThan(trip_miles,0.0)",
                   "LessThan(trip_miles,200.0)", "GreaterThanOrEqual(base_passenger_fare,0.0)"):
        assert wanted in pushed, wanted
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("HashAggregate") < text.index("Exchange") < text.index("Filter")


def test_marts_read_only_the_columns_they_need(spark, landed):
    path = work_path(spark, "test-facts")
    enrich.to_facts(enrich.enrich_trips(clean.clean_trips(landed))).write.parquet(path)
    stored = spark.read.parquet(path)
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan(marts.trajets_par_jour_semaine(stored))).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} <= {
        "plateforme", "revenu_total", "jour_semaine", "nom_jour", "est_weekend"}
    assert plan(explore.explore_top15(stored, None)).count("TakeOrderedAndProject") == 1


def test_preview_reads_the_first_dates_only(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = spark.range(1000).selectExpr(
        *[f"cast(id AS int) AS {c}" for c in explore.FACT_COLUMNS if c != "date_trajet"],
        "date_add(date'2024-01-01', cast(id div 100 AS int)) AS date_trajet")
    rows.write.partitionBy("date_trajet").parquet(path)
    first = explore.explore_preview(spark.read.parquet(path), n=150)
    days = sorted({str(row.date_trajet) for row in first.collect()})
    assert days == ["2024-01-01", "2024-01-02"] and first.count() == 150
    text = plan(first)
    assert re.search(r"PartitionFilters: \[[^\]]*date_trajet[^\]]*<= Subquery", text) or "scalar-subquery" in text.lower()


def test_funnel_shuffles_digests_and_not_columns(spark):
    text = plan(clean.clean_funnel(raw_trips(spark, SF)))
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "__row" in line and "trip_miles" not in line and "pickup_datetime" not in line


def test_star_load_does_not_shuffle_staged_rows(spark, tmp_path, monkeypatch):
    seen = []
    path = str(tmp_path / "enriched")
    enrich.enrich_trips(clean.clean_trips(raw_trips(spark, SF))).where("date_trajet < '1996-02-01'").coalesce(
        2).write.partitionBy("date_trajet").parquet(path)
    staged = spark.read.parquet(path)
    rows = star.to_fact_trips(staged, "fhvhv")
    seen.append(plan(rows.sortWithinPartitions("pickup_date")))
    assert "Exchange" not in seen[0]
    assert warehouse.load_fact_trips(rows, "plan_db", laid_out=True) == staged.count()


def test_partition_guard_refuses_what_reads_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).selectExpr("id", "date_add(date'2024-01-01', cast(id % 5 AS int)) AS day").write.partitionBy(
        "day").parquet(path)
    stored = spark.read.parquet(path)
    stored.createOrReplaceTempView("guarded")
    bounded = "day >= date'2024-01-02'"
    for good in (stored.where(bounded), stored.where("day IN (date'2024-01-02', date'2024-01-03')"),
                 stored.where(f"{bounded} AND id > 3"), spark.range(3)):
        assert quality.require_partition_filter(good) is good
    cached = stored.cache()
    cached.count()
    try:
        with pytest.raises(quality.MissingPartitionFilter):
            quality.require_partition_filter(cached.where("id > 1"))
    finally:
        cached.unpersist()
    bad = [stored, stored.where("day IS NOT NULL"), stored.where(f"{bounded} OR id = 1"),
           stored.alias("a").join(stored.alias("b"), "day"),
           spark.sql(f"SELECT * FROM guarded WHERE {bounded} AND id > (SELECT avg(id) FROM guarded)")]
    for frame in bad:
        with pytest.raises(quality.MissingPartitionFilter):
            quality.require_partition_filter(frame)
    with settings(spark, {"spark.sql.sources.useV1SourceList": ""}):
        with pytest.raises(quality.MissingPartitionFilter):
            quality.require_partition_filter(spark.read.parquet(path))
        quality.require_partition_filter(spark.read.parquet(path).where(bounded))


def test_zone_joins_follow_the_aggregation(spark):
    for name in ("report_top_zones", "report_top_od", "explore_zone_labels"):
        text = plan(QUERIES[name](spark, SF))
        join, aggregate = text.index("Join"), text.rindex("HashAggregate")
        assert join < aggregate, name


def test_large_zone_tables_are_not_broadcast(spark):
    """Nothing is hinted: beyond the threshold the semi-join becomes a shuffle join."""
    trips = facts(spark, SF)
    zones = spark.range(10).selectExpr("id AS zone_id", "'EUROPE' AS arrondissement", "'z' AS zone_nom")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(filters.filter_borough(trips, zones, ["EUROPE"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_derived_columns_are_not_shuffled_by_date(spark):
    """The rebalance for a write by date carries raw columns; the digest and the facts are made behind it."""
    dated = enrich.enrich_by_date(clean.clean_trips(raw_trips(spark, SF)))
    for rows, derived in ((star.to_fact_trips(dated, "fhvhv"), "sha2("), (enrich.to_facts(dated), "plateforme")):
        text = plan(rows.sortWithinPartitions("PULocationID" if derived == "plateforme" else "pickup_location_id"))
        above, below = text.split("REBALANCE_PARTITIONS_BY_COL")
        assert derived in above and derived not in below


def test_small_inputs_are_scanned_and_shuffled_in_small_tasks(spark):
    mib, tib = 2**20, 2**40
    assert [session.split_bytes(n) // mib for n in (0, 600 * mib, 2**35, tib)] == [8, 8, 16, 32]
    with session.sized_for(spark, 800 * mib):
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "100"
