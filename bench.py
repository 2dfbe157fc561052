"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local threads (default 8).

The given tables hold no trips, so raw trips are first derived from them and written as one file per
thread, the way monthly files arrive (``trips_derived``). ``raw_landing`` lands those files in a lake with
``land_raw``. Cleaning, facts and marts start from the lake; reports and explorations run on the stored,
partitioned tables, which is how they are used. Queries go to the ``noop`` sink, which computes all rows and
columns. ``facts_write`` writes the partitioned fact table and ``marts_from_facts`` all six marts from it, as the
pipeline does. Each action is run once to warm up and then three times (writes once); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridelake_checks.registry import SELECTION, dim_zones, zones  # noqa: E402
from ridelake_checks.trip_view import REPORT_END, REPORT_START, raw_trips, service_type  # noqa: E402
from ridelake.operators import clean, enrich, filters, marts, star  # noqa: E402
from ridelake.plans import explore, reports  # noqa: E402
from ridelake.session import build_session, discard, settings, work_path, work_table  # noqa: E402
from ridelake.sinks.parquet import spread, write_facts, write_marts
from ridelake.sources.landing import land_raw, read_lake  # noqa: E402


def timed(action, runs: int = 3) -> float:
    action()
    seconds = []
    for _ in range(runs):
        started = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("ridelake-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # The test tables have a few trips per date: spread the 2,500 small files over all threads.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.files.openCostInBytes": "64k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):  # one machine: its own folder will do
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ridelake-bench-"))

    source, lake, facts_at, star_at, out = (work_path(spark, f"bench-{name}") for name in (
        "in", "lake", "facts", "star", "marts"))
    write = {"spark.sql.sources.partitionOverwriteMode": "static"}

    def once(action) -> float:
        started = time.perf_counter()
        action()
        return round(time.perf_counter() - started, 3)

    times = {"trips_derived": once(lambda: raw_trips(spark, sf_dir).repartition(int(cpus)).write.parquet(source)),
             "raw_landing": once(lambda: land_raw(spark, source, lake))}
    raw = read_lake(spark, lake)
    enriched = enrich.enrich_trips(clean.clean_trips(raw))
    facts = enrich.to_facts(enriched)
    fact_trips = star.to_fact_trips(enriched, service_type())
    times["facts_write"] = once(lambda: write_facts(facts, facts_at))
    with settings(spark, write):
        times["star_write"] = once(lambda: spread(fact_trips, "pickup_date", "pickup_location_id").write.partitionBy(
            "pickup_date").parquet(star_at))
    stored, stored_star = spark.read.parquet(facts_at), spark.read.parquet(star_at)
    dims, places = dim_zones(spark, sf_dir), zones(spark, sf_dir)
    period = (REPORT_START, REPORT_END)
    headline = {
        "clean_trips": lambda: clean.clean_trips(raw),
        "clean_funnel": lambda: clean.clean_funnel(raw),
        "clean_summary": lambda: clean.clean_summary(raw),
        "facts": lambda: facts,
        "fact_trips": lambda: fact_trips,
        "kpi_par_plateforme": lambda: marts.kpi_par_plateforme(enriched),
        "trajets_par_heure": lambda: marts.trajets_par_heure(enriched),
        "revenu_par_zone_depart": lambda: marts.revenu_par_zone_depart(enriched),
        "report_daily": lambda: reports.report_daily(stored_star, *period),
        "report_top_zones": lambda: reports.report_top_zones(stored_star, dims, *period),
        "report_top_od": lambda: reports.report_top_od(stored_star, dims, *period),
        "report_tipping": lambda: reports.report_tipping(stored_star, *period),
        "filter_combined": lambda: filters.apply_filters(stored, places, SELECTION),
        "explore_kpis": lambda: explore.explore_kpis(stored),
        "explore_zone_labels": lambda: explore.explore_zone_labels(stored, places),
        "explore_preview": lambda: explore.explore_preview(stored),
    }
    for name, query in headline.items():
        times[name] = timed(lambda: query().write.format("noop").mode("overwrite").save())

    def all_marts():
        with work_table(marts.rollup_trips(stored), "bench-rollup") as rollup:
            write_marts(marts.build_marts(rollup), out)

    times["marts_from_facts"] = timed(all_marts, 1)
    for path in (source, lake, facts_at, star_at, out):
        discard(spark, path)

    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
