"""The monthly chain: land, transform, load.

Each stage hands over by files only and can be run again on its own.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, PySparkException as SparkException
from pyspark.sql import DataFrame, SparkSession

from ridelake.operators.clean import clean_trips
from ridelake.operators.enrich import enrich_by_date, to_facts
from ridelake.operators.marts import build_marts, rollup_trips
from ridelake.operators.star import to_dim_zones, to_fact_trips
from ridelake.schema import FACT_PARTITION, FACT_TABLE
from ridelake.session import discard, input_bytes, pin_utc, sized_for, work_path, work_table
from ridelake.sinks.parquet import write_facts, write_marts
from ridelake.sinks.warehouse import load_dim_zones, load_fact_trips, load_tables, new_version
from ridelake.sources.files import expected_files, missing_files
from ridelake.sources.landing import land_raw, read_lake
from ridelake.sources.tables import read_partitioned, read_zone_lookup

log = logging.getLogger(__name__)


@dataclass
class Outcome:
    """What a run did: landing actions, expected files that are missing, paths written, rows in, rows kept,
    rows per table, and the tables that could not be loaded."""

    actions: dict[str, int] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)
    rows_in: int = 0
    rows_kept: int = 0
    tables: dict[str, int] = field(default_factory=dict)
    failed: list[str] = field(default_factory=list)


def transform(
    spark: SparkSession, raw: DataFrame, out: str, keep_enriched: bool = False
) -> tuple[dict[str, str], str | None]:
    """Write the fact table and the six marts of ``raw`` under ``out``; returns their paths.

    The raw trips are read and deduplicated once. The marts start from the written facts: one
    scan of the columns they need gives a rollup, which is stored and feeds all six.

    With ``keep_enriched`` the clean rows with all their columns are written to the shared work
    folder first (the star schema needs columns that the facts do not have) and facts are read
    from there; that path is returned too, for the caller to use and discard.
    """
    staged = work_path(spark, "enriched") if keep_enriched else None
    try:
        with sized_for(spark, input_bytes(raw)):
            enriched = enrich_by_date(clean_trips(raw))
            facts_path = f"{out}/{FACT_TABLE}"
            if staged:
                (enriched.sortWithinPartitions(FACT_PARTITION, "PULocationID").write.partitionBy(FACT_PARTITION)
                 .parquet(staged))
                # Staged files already hold one date each: no second shuffle to write the facts.
                (to_facts(read_partitioned(spark, staged)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "static").partitionBy(FACT_PARTITION).parquet(facts_path))
            else:
                write_facts(to_facts(enriched), facts_path, laid_out=True)
            with work_table(rollup_trips(read_partitioned(spark, facts_path)), "rollup") as rollup:
                paths = write_marts(build_marts(rollup), out)
            return {FACT_TABLE: facts_path, **paths}, staged
    except BaseException:
        if staged:
            discard(spark, staged)
        raise


def run(
    spark: SparkSession, raw: str, lake: str, out: str, db: str,
    zones_csv: str | None = None, service_type: str = "fhvhv",
    dataset: str | None = None, years: Sequence[int] = (), months: Sequence[str] = (),
) -> Outcome:
    """Land the files of folder ``raw``, transform the lake, load the warehouse and the star schema.

    Each run writes its tables to a folder of its own below ``out``, and readers of the warehouse see it when it is
    complete; ``warehouse.vacuum`` deletes the older ones. The zone dimension is loaded if there is a lookup that can be read. With ``dataset``, ``years`` and
    ``months`` the monthly files that should be there and are not are reported.
    """
    pin_utc(spark)
    outcome = Outcome()
    actions = land_raw(spark, raw, lake)
    outcome.actions = {row["action"]: row["count"] for row in actions.groupBy("action").count().collect()}
    if dataset:
        absent = missing_files(expected_files(spark, dataset, years, months), actions.select("name"))
        outcome.missing = [row["name"] for row in absent.orderBy("name").collect()]
        if outcome.missing:
            log.warning("%d expected file(s) missing: %s", len(outcome.missing), ", ".join(outcome.missing))

    trips = read_lake(spark, lake)
    version = new_version(out)
    outcome.paths, staged = transform(spark, trips, version, keep_enriched=True)
    try:
        outcome.rows_in = trips.count()
        outcome.rows_kept = read_partitioned(spark, outcome.paths[FACT_TABLE]).count()
        rejected = 100 * (1 - outcome.rows_kept / outcome.rows_in) if outcome.rows_in else 0
        log.info("%d rows in, %d kept (%.1f %% rejected)", outcome.rows_in, outcome.rows_kept, rejected)
        outcome.tables, outcome.failed = load_tables(spark, version, db)
        star, failed = load_star(spark, staged, zones_csv, db, service_type)
        outcome.tables.update(star)
        outcome.failed += failed
    finally:
        discard(spark, staged)
    return outcome


def load_star(
    spark: SparkSession, enriched_path: str, zones_csv: str | None, db: str, service_type: str
) -> tuple[dict[str, int], list[str]]:
    """Replace the star schema by the staged trips and the zone lookup; returns rows per table, and failures."""
    enriched = read_partitioned(spark, enriched_path)
    with sized_for(spark, input_bytes(enriched)):
        tables = {"fact_trips": load_fact_trips(to_fact_trips(enriched, service_type), db, laid_out=True)}
    if zones_csv is None:
        return tables, []
    try:
        tables["dim_zones"] = load_dim_zones(to_dim_zones(read_zone_lookup(spark, zones_csv)), db)
    except (AnalysisException, SparkException) as error:
        log.warning("the zone lookup cannot be loaded: %s", error)
        return tables, ["dim_zones"]
    return tables, []
