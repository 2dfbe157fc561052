"""Catalog tables: definitions, loads, and the views through which readers see one version at a time."""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.marts import MARTS
from ridelake.operators.quality import FACT_REQUIRED, ZONE_REQUIRED, required
from ridelake.schema import FACT_PARTITION, FACT_TABLE, STAR_PARTITION
from ridelake.session import settings
from ridelake.sinks.parquet import interleaved, spread
from ridelake.sources.files import existing

log = logging.getLogger(__name__)

# Loaded table -> its partition column, if any.
TABLES = {FACT_TABLE: FACT_PARTITION, **{name: None for name in MARTS}}

# Declared columns of the star schema.
FACT_TRIPS_COLUMNS = {
    "trip_id": ("STRING NOT NULL", "digest of the raw row"),
    "pickup_datetime": ("TIMESTAMP NOT NULL", "when the ride began"),
    "dropoff_datetime": ("TIMESTAMP NOT NULL", "when the ride ended"),
    "pickup_location_id": ("BIGINT", "zone it began in"),
    "dropoff_location_id": ("BIGINT", "zone it ended in"),
    "trip_miles": ("DOUBLE", "miles driven"),
    "trip_duration_min": ("DOUBLE", "minutes driven"),
    "avg_speed_mph": ("DOUBLE", "miles per hour"),
    "base_fare": ("DOUBLE", "fare before extras"),
    "tips": ("DOUBLE", "given on top"),
    "tolls": ("DOUBLE", "road charges"),
    "total_amount": ("DOUBLE", "fare and extras"),
    "service_type": ("STRING", "kind of ride"),
    "pickup_hour": ("BIGINT", "0 to 23"),
    "pickup_dayofweek": ("BIGINT", "Sunday is 1"),
    STAR_PARTITION: ("DATE", "day it began; partitions the table"),
}
DIM_ZONES_COLUMNS = {
    "location_id": ("BIGINT NOT NULL", "zone number"),
    "borough": ("STRING", "district"),
    "zone_name": ("STRING", "what the zone is called"),
    "service_zone": ("STRING", "licence area"),
}


def _create(spark: SparkSession, table: str, columns: dict, tail: str = "") -> None:
    database = table.rsplit(".", 1)[0]
    listed = ", ".join(f"{name} {kind} COMMENT '{note}'" for name, (kind, note) in columns.items())
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet {tail}")


def create_fact_trips(spark: SparkSession, db: str) -> None:
    """One row per trip, partitioned by pickup date; clustering happens when it is loaded."""
    _create(spark, f"{db}.fact_trips", FACT_TRIPS_COLUMNS, f"PARTITIONED BY ({STAR_PARTITION})")


def create_dim_zones(spark: SparkSession, db: str) -> None:
    _create(spark, f"{db}.dim_zones", DIM_ZONES_COLUMNS)


def load_fact_trips(fact_trips: DataFrame, db: str, laid_out: bool = False) -> int:
    """Replace the rows of the table; returns how many it then has.

    Required columns are enforced in the same pass, and both zones cluster the rows of a date. Rows that are
    ``laid_out`` come from files that hold one date each, or from a rebalance by date: they are sorted within tasks and
    not shuffled.
    """
    spark = fact_trips.sparkSession
    create_fact_trips(spark, db)
    checked = required(fact_trips, FACT_REQUIRED).select(*FACT_TRIPS_COLUMNS)
    cluster = interleaved("pickup_location_id", "dropoff_location_id")
    rows = (checked.sortWithinPartitions(STAR_PARTITION, cluster) if laid_out
            else spread(checked, STAR_PARTITION, cluster))
    # Dates that no longer occur must go too, whatever the session's overwrite mode.
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        rows.write.mode("overwrite").insertInto(f"{db}.fact_trips")
    return spark.table(f"{db}.fact_trips").count()


def load_dim_zones(dim_zones: DataFrame, db: str) -> int:
    spark = dim_zones.sparkSession
    create_dim_zones(spark, db)
    (required(dim_zones, ZONE_REQUIRED).select(*DIM_ZONES_COLUMNS).coalesce(1)
     .write.mode("overwrite").insertInto(f"{db}.dim_zones"))
    return spark.table(f"{db}.dim_zones").count()


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows)``; over Parquet tables the counts come from the footers."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, frame in tables.items()]
    first, *rest = counts
    for count in rest:
        first = first.union(count)
    return first


def new_version(out: str) -> str:
    """A folder below ``out`` that no run has written to. Tables go on reading the one they point at."""
    return f"{out.rstrip('/')}/version-{uuid.uuid4().hex}"


def _point(spark: SparkSession, db: str, table: str, version: str) -> None:
    """Let readers of ``table`` see ``version``: one change of the catalog, so they see the old rows or the new."""
    for old in spark.sql(f"SHOW TABLES IN {db} LIKE '{table}'").where("NOT isTemporary").collect():
        if spark.catalog.getTable(f"{db}.{old.tableName}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {db}.{table}")  # not made by these loads: a name cannot be table and view
    spark.sql(f"CREATE OR REPLACE VIEW {db}.{table} AS SELECT * FROM {db}.{version}")


def load_tables(spark: SparkSession, base: str, db: str) -> tuple[dict[str, int], list[str]]:
    """Make the processed Parquet files the warehouse's tables; returns ``{table: rows}`` and the failures.

    The files are registered where they lie, not copied: each load makes a new version of a table beside the old
    ones, reads it, and then turns the view of the table's name to it. A load that dies before or after leaves a
    readable table. ``vacuum`` removes versions that no view points at. A table without files is skipped with a
    warning; one that fails is logged and the rest go on.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {db}")
    loaded: dict[str, int] = {}
    failed: list[str] = []
    for table, partition in TABLES.items():
        try:
            if existing(lambda: spark.read.parquet(f"{base}/{table}")) is None:
                log.warning("table skipped, no files: %s", table)
                continue
            version = f"{table}__{uuid.uuid4().hex}"
            spark.catalog.createTable(f"{db}.{version}", path=f"{base}/{table}", source="parquet")
            if partition:
                spark.catalog.recoverPartitions(f"{db}.{version}")
            rows = spark.table(f"{db}.{version}").count()
            _point(spark, db, table, version)
            loaded[table] = rows
            log.info("table %s loaded: %d row(s)", table, rows)
        except Exception:  # one bad table must not stop the others
            log.exception("loading %s failed", table)
            failed.append(table)
    return loaded, failed


def _detail(spark: SparkSession, table: str, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == name).collect()
    return rows[0]["data_type"] if rows else ""


def vacuum(spark: SparkSession, db: str) -> list[str]:
    """Drop the versions that no view points at, and delete their files where they lie in a folder of ``new_version``
    that no view reads. Run it when no load is under way and no query still reads an old version; returns the versions."""
    names = [row.tableName for row in spark.sql(f"SHOW TABLES IN {db}").where("NOT isTemporary").collect()]
    versions = {name for name in names if re.fullmatch(rf"({'|'.join(TABLES)})__[0-9a-f]{{32}}", name)}
    shown = {name for table in TABLES if table in names
             for name in re.findall(r"\w+__[0-9a-f]{32}", _detail(spark, f"{db}.{table}", "View Text"))}
    places = {name: _detail(spark, f"{db}.{name}", "Location") for name in versions}
    read = {places[name] for name in shown & versions}
    stale = sorted(versions - shown)
    for name in stale:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
        if places[name] not in read and re.search(r"/version-[0-9a-f]{32}/[^/]+$", places[name]):
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(places[name])
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return stale
