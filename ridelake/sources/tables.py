"""Reading the zone lookup and the written fact table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ridelake.operators.star import exploration_zones, to_dim_zones
from ridelake.plans.explore import facts_with_day_fr
from ridelake.schema import FACT_COLUMNS


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The published CSV (``LocationID, Borough, Zone, service_zone``), columns found by name."""
    return spark.read.option("header", True).csv(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame | None:
    """``(zone_id, arrondissement, zone_nom)``, or None if the lookup cannot be read."""
    try:
        return exploration_zones(to_dim_zones(read_zone_lookup(spark, path)))
    except AnalysisException:
        return None


def read_partitioned(spark: SparkSession, base: str) -> DataFrame:
    """A partitioned table; the partition column comes back from the paths with its type."""
    return spark.read.parquet(base)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """The fact table for exploration, with the French weekday name."""
    return facts_with_day_fr(read_partitioned(spark, path).select(*FACT_COLUMNS))
