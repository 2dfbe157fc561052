"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake_checks import loads
from ridelake_checks.trip_view import (
    DATASET, REPORT_END, REPORT_START, raw_trips, service_type, table, zone_lookup)
from ridelake.operators import clean, enrich, filters, marts, quality, star
from ridelake.plans import explore, reports
from ridelake.session import settings
from ridelake.sinks.parquet import write_facts
from ridelake.sinks.warehouse import table_row_counts
from ridelake.sources import files, landing
from ridelake.sources.tables import read_partitioned

Query = Callable[[SparkSession, str], DataFrame]


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_trips(clean.clean_trips(raw_trips(spark, sf_dir)))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.to_facts(enriched(spark, sf_dir))


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.to_fact_trips(enriched(spark, sf_dir), service_type())


def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.to_dim_zones(zone_lookup(spark, sf_dir))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.exploration_zones(dim_zones(spark, sf_dir))


def _on_raw(operator) -> Query:
    return lambda spark, sf_dir: operator(raw_trips(spark, sf_dir))


def _on_clean(operator) -> Query:
    return lambda spark, sf_dir: operator(clean.clean_trips(raw_trips(spark, sf_dir)))


def _on_enriched(operator) -> Query:
    return lambda spark, sf_dir: operator(enriched(spark, sf_dir))


def _on_facts(operator, *args) -> Query:
    return lambda spark, sf_dir: operator(facts(spark, sf_dir), *args)


def _on_facts_and_zones(operator, *args) -> Query:
    return lambda spark, sf_dir: operator(facts(spark, sf_dir), zones(spark, sf_dir), *args)


def _report(operator) -> Query:
    return lambda spark, sf_dir: operator(fact_trips(spark, sf_dir), REPORT_START, REPORT_END)


def _zone_report(operator) -> Query:
    return lambda spark, sf_dir: operator(
        fact_trips(spark, sf_dir), dim_zones(spark, sf_dir), REPORT_START, REPORT_END)


def raw_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files with different columns and integer widths as one frame."""
    return files.read_unified(spark, f"{sf_dir}/{{lineitem,orders}}.parquet")


def widen_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.widen_ints(table(spark, sf_dir, "lineitem"))


def union_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of two "files", the second of which lacks a column and orders the others differently."""
    trips = raw_trips(spark, sf_dir)
    later = trips.where("l_linenumber > 3").drop("airport_fee")
    return files.union_tolerant([
        trips.where("l_linenumber <= 3"), later.select(*reversed(later.columns))])


def _monthly(trips: DataFrame, rows) -> DataFrame:
    """Monthly file names with a size each, as a listing of the months that occur in the trips."""
    name = F.concat(F.lit(f"{DATASET}_"), F.date_format("pickup_datetime", "yyyy-MM"), F.lit(".parquet"))
    return trips.where("pickup_datetime IS NOT NULL").groupBy(name.alias("name")).agg(rows.alias("length"))


def expected_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected monthly files and whether the trips have that month."""
    listed = _monthly(raw_trips(spark, sf_dir), F.count(F.lit(1))).select("name")
    expected = files.expected_files(
        spark, DATASET, range(1992, 2003), [f"{month:02d}" for month in range(1, 13)])
    absent = files.missing_files(expected, listed)
    return absent.select("name", F.lit(True).alias("missing")).union(
        expected.join(listed, "name", "left_semi").select("name", F.lit(False)))


def head_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.head_per_file(
        spark, [f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet"], 10)


def landing_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source: months with all their trips. Lake: months before 1999, some with fewer trips."""
    trips = raw_trips(spark, sf_dir)
    before = trips.where("pickup_datetime < timestamp_ntz'1999-01-01'").where(
        "trip_miles > 0 OR month(pickup_datetime) > 6")
    return landing.landing_actions(
        _monthly(trips, F.count(F.lit(1))), _monthly(before, F.count(F.lit(1))))


def facts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts after a partitioned write and a read that recovers the date from the paths."""
    path = loads.place(spark, "facts")
    with settings(spark, loads.SMALL):
        write_facts(enrich.to_facts(enrich.enrich_by_date(clean.clean_trips(raw_trips(spark, sf_dir)))), path, laid_out=True)
    return read_partitioned(spark, path)


def warehouse_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the fact table and of the six marts."""
    trips = facts(spark, sf_dir)
    return table_row_counts({"trajets_nettoyes": trips, **marts.build_marts(trips)})


def not_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations among the raw trips, where there are some."""
    return quality.check_not_null(
        raw_trips(spark, sf_dir), ["request_datetime", "pickup_datetime", "dropoff_datetime", "tips"])


SELECTION = filters.Filters(
    platforms=["Uber", "Lyft", "Autre"], start="1996-03-01", end="1999-06-30", first_hour=6,
    last_hour=20, day_type=filters.WEEKDAYS, shared_only=True, boroughs=["EUROPE", "ASIA"])

QUERIES: dict[str, Query] = {
    # sources
    "raw_unified": raw_unified,
    "widen_ints": widen_ints,
    "union_tolerant": union_tolerant,
    "expected_periods": expected_periods,
    "head_per_file": head_per_file,
    "dim_zones": zones,
    "facts_with_day_fr": _on_facts(explore.facts_with_day_fr),
    "facts_roundtrip": facts_roundtrip,
    # tables and constraints
    "warehouse_row_counts": warehouse_row_counts,
    "landing_actions": landing_actions,
    "dim_zones_table": dim_zones,
    "not_null_check": not_null_check,
    "fact_trips": fact_trips,
    # cleaning
    "clean_dedup": _on_raw(clean.clean_dedup),
    "clean_not_null": _on_raw(clean.clean_not_null),
    "clean_time_order": _on_raw(clean.clean_time_order),
    "clean_trip_time": _on_raw(clean.clean_trip_time),
    "clean_trip_miles": _on_raw(clean.clean_trip_miles),
    "clean_fare": _on_raw(clean.clean_fare),
    "clean_trips": _on_raw(clean.clean_trips),
    "clean_summary": _on_raw(clean.clean_summary),
    "clean_funnel": _on_raw(clean.clean_funnel),
    # enrichment
    "enrich_platform": _on_clean(enrich.enrich_platform),
    "enrich_duration": _on_clean(enrich.enrich_duration),
    "enrich_wait": _on_clean(enrich.enrich_wait),
    "enrich_speed": _on_clean(enrich.enrich_speed),
    "enrich_revenue": _on_clean(enrich.enrich_revenue),
    "enrich_payout": _on_clean(enrich.enrich_payout),
    "enrich_flags": _on_clean(enrich.enrich_flags),
    "enrich_calendar": _on_clean(enrich.enrich_calendar),
    "facts": facts,
    # marts
    "kpi_globaux": _on_enriched(marts.kpi_globaux),
    "kpi_par_plateforme": _on_enriched(marts.kpi_par_plateforme),
    "trajets_par_heure": _on_enriched(marts.trajets_par_heure),
    "trajets_par_jour_semaine": _on_enriched(marts.trajets_par_jour_semaine),
    "trajets_par_annee_mois": _on_enriched(marts.trajets_par_annee_mois),
    "revenu_par_zone_depart": _on_enriched(marts.revenu_par_zone_depart),
    "platform_counts": _on_enriched(marts.platform_counts),
    # reports
    "report_daily": _report(reports.report_daily),
    "report_heatmap": _report(reports.report_heatmap),
    "report_top_zones": _zone_report(reports.report_top_zones),
    "report_top_od": _zone_report(reports.report_top_od),
    "report_tipping": _report(reports.report_tipping),
    "report_quality": _report(reports.report_quality),
    # filters
    "filter_platform": _on_facts(filters.filter_platform, ["Uber", "Juno"]),
    "filter_dates": _on_facts(filters.filter_dates, "1997-02-01", "1998-01-31"),
    "filter_hours": _on_facts(filters.filter_hours, 7, 9),
    "filter_daytype": _on_facts(filters.filter_daytype, filters.WEEKEND),
    "filter_shared": _on_facts(filters.filter_shared, True),
    "filter_wav": _on_facts(filters.filter_wav, True),
    "filter_borough": _on_facts_and_zones(filters.filter_borough, ["EUROPE"]),
    "filter_combined": _on_facts_and_zones(filters.apply_filters, SELECTION),
    # exploration
    "explore_kpis": _on_facts(explore.explore_kpis),
    "explore_platform_share": _on_facts(explore.explore_platform_share),
    "explore_platform_means": _on_facts(explore.explore_platform_means),
    "explore_by_hour": _on_facts(explore.explore_by_hour),
    "explore_by_weekday": _on_facts(explore.explore_by_weekday),
    "explore_by_month": _on_facts(explore.explore_by_month),
    "explore_by_zone": _on_facts(explore.explore_by_zone),
    "explore_zone_labels": _on_facts_and_zones(explore.explore_zone_labels),
    "explore_top15": _on_facts_and_zones(explore.explore_top15),
    "explore_zone_table": _on_facts_and_zones(explore.explore_zone_table),
    "explore_preview": _on_facts(explore.explore_preview),
    "explore_row_count": _on_facts(explore.explore_row_count),
    "explore_domains": _on_facts_and_zones(explore.explore_domains),
    # what writes, and what reads what was written
    "landed_rows": loads.landed_rows,
    "refreshed_mart": loads.refreshed_mart,
    "raw_unified_drift": loads.raw_unified_drift,
    "zones_from_csv": loads.zones_from_csv,
    "csv_roundtrip": loads.csv_roundtrip,
    "loaded_tables": loads.loaded_tables,
    "sample_written": loads.sample_written,
    "listing": loads.listing,
    "profile": loads.profile,
    "empty_signal": loads.empty_signal,
    "stored_preview": loads.stored_preview,
    **{f"rollup_{name}": loads.mart_from_rollup(name) for name in marts.MARTS},
    "stored_report_daily": loads.on_stored_star(reports.report_daily, REPORT_START, REPORT_END),
    "stored_report_heatmap": loads.on_stored_star(reports.report_heatmap, REPORT_START, REPORT_END),
    "stored_report_top_zones": loads.on_stored_star(
        reports.report_top_zones, REPORT_START, REPORT_END, zones=True),
    "stored_report_top_od": loads.on_stored_star(reports.report_top_od, REPORT_START, REPORT_END, zones=True),
    "stored_report_tipping": loads.on_stored_star(reports.report_tipping, REPORT_START, REPORT_END),
    "stored_report_quality": loads.on_stored_star(reports.report_quality, REPORT_START, REPORT_END),
}
