"""Queries that write: each works in a folder of its own, returns a small result and leaves nothing behind.

Only the two large partitioned tables, facts and star, are written once for a session and shared by the queries
that read them: thousands of small date folders take longer to make than everything else together.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators import clean, enrich, marts, star
from ridelake.plans import explore, incremental
from ridelake.session import ADVISORY_BYTES, OPEN_FILES, discard, input_bytes, settings, sized_for, work_path, work_table
from ridelake.sinks import parquet, warehouse
from ridelake.sources import files, footers, landing, tables
from ridelake_checks.trip_view import DATASET, raw_trips, service_type, zone_lookup

Query = Callable[[SparkSession, str], DataFrame]
# The test tables hold few trips per date: without this, AQE would write all dates in one task. Tasks of 16 MB as
# shuffled sort some 100 MB of rows, which small executors hold.
SMALL = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k", ADVISORY_BYTES: "16m"}


def place(spark: SparkSession, name: str) -> str:
    """A path in the shared folder. A local session that names none, such as a test's, gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ridelake-checks-"))
    return work_path(spark, name)


@contextmanager
def folder(spark: SparkSession, name: str):
    """A path in the shared folder, deleted afterwards."""
    path = place(spark, name)
    try:
        with settings(spark, SMALL):
            yield path
    finally:
        discard(spark, path)


def held(df: DataFrame) -> DataFrame:
    """The rows of a small result, so that its files can go."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@contextmanager
def schema(spark: SparkSession, path: str):
    name = f"ridelake_{path.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{path}/db'")
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_trips(clean.clean_trips(raw_trips(spark, sf_dir)))


def _by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_by_date(clean.clean_trips(raw_trips(spark, sf_dir)))


def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per monthly file after a landing, a second one with June 1997 cut to whole miles, and a third."""
    trips = raw_trips(spark, sf_dir).where("pickup_datetime IS NOT NULL")
    with folder(spark, "landed") as path:
        for cut in (None, "trip_miles % 9 = 0", "true"):
            _monthly_files(spark, trips, path, cut)
            landing.land_raw(spark, f"{path}/in", f"{path}/lake")
        month = F.date_format("pickup_datetime", "yyyy-MM")
        return held(landing.read_lake(spark, f"{path}/lake").groupBy(
            F.concat(F.lit(f"{DATASET}_"), month, F.lit(".parquet")).alias("name")).agg(F.count(F.lit(1)).alias("rows")))


def refreshed_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators per platform after all months were landed and computed, June 1997 was cut to whole miles and landed
    again, and only the dates it touches were computed again; with the number of these dates."""
    trips = raw_trips(spark, sf_dir).where("pickup_datetime IS NOT NULL")
    with folder(spark, "refreshed") as path:
        for cut in (None, "trip_miles % 9 = 0"):
            _monthly_files(spark, trips, path, cut)
            landing.land_raw(spark, f"{path}/in", f"{path}/lake")
            done = incremental.refresh(spark, f"{path}/lake", f"{path}/out")
        mart = spark.read.parquet(f"{path}/out/kpi_par_plateforme")
        return held(mart.withColumn("touched_dates", F.lit(len(done.dates)).cast("long")))


CHANGED = "1997-06"


def _monthly_files(spark: SparkSession, trips: DataFrame, path: str, cut: str | None) -> None:
    """One file of trips for each month in ``{path}/in``. With a ``cut`` only the changed month's file is replaced, by its
    trips that meet it; the other files stay as they are."""
    dated = trips.withColumn("month", F.date_format("pickup_datetime", "yyyy-MM"))
    chosen = dated if cut is None else dated.where(F.col("month") == CHANGED).where(cut)
    with sized_for(spark, input_bytes(trips)), settings(spark, OPEN_FILES):
        chosen.repartition("month").write.mode("overwrite").partitionBy("month").parquet(f"{path}/split")
    _as_files(spark, f"{path}/split", f"{path}/in", None if cut is None else CHANGED)


def _as_files(spark: SparkSession, split: str, into: str, only: str | None = None) -> None:
    """The one file of each month folder under a monthly name, in place of all that were there or of ``only`` one month's."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(split).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at(f"{into}/{DATASET}_{only}.parquet" if only else into), True)
    fs.mkdirs(at(into))
    for folder_ in fs.listStatus(at(split)):
        key, _, month = folder_.getPath().getName().partition("=")
        if key == "month":
            for part in fs.listStatus(folder_.getPath()):
                if part.getPath().getName().endswith(".parquet"):
                    fs.rename(part.getPath(), at(f"{into}/{DATASET}_{month}.parquet"))


def raw_unified_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of files of trips: zones as INT and as BIGINT, and a fee that the later ones lack."""
    trips = raw_trips(spark, sf_dir)
    with folder(spark, "drift") as path:
        (trips.where("l_linenumber <= 3").withColumn("PULocationID", F.col("PULocationID").cast("int"))
         .withColumn("DOLocationID", F.col("DOLocationID").cast("int")).write.parquet(f"{path}/a"))
        trips.where("l_linenumber > 3").drop("airport_fee").write.parquet(f"{path}/b")
        whole = files.read_unified(spark, f"{path}/*/*.parquet")
        return held(whole.groupBy("PULocationID").agg(
            F.count(F.lit(1)).alias("trips"), F.count("airport_fee").alias("fees"),
            F.sum("DOLocationID").alias("dropoffs")))


def zones_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    with folder(spark, "zones") as path:
        parquet.export_csv(zone_lookup(spark, sf_dir), f"{path}/zones")
        return held(tables.read_zones(spark, f"{path}/zones"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    with folder(spark, "csv") as path:
        parquet.export_csv(marts.trajets_par_heure(_enriched(spark, sf_dir)), f"{path}/out")
        back = spark.read.option("header", True).csv(f"{path}/out")
        return held(back.select(F.col("heure").cast("int"), "plateforme", F.col("nombre_trajets").cast("long")))


def loaded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the nine tables after marts and facts were written and registered, and the star schema loaded."""
    facts = stored_facts(spark, sf_dir)
    with folder(spark, "load") as path, schema(spark, path) as db:
        # A few folders suffice to register a partitioned table: by year, not by day. They are as few as tasks can keep
        # open, so that rows are neither brought together nor sorted for them.
        with settings(spark, OPEN_FILES):
            facts.withColumn("date_trajet", F.trunc("date_trajet", "year")).write.partitionBy("date_trajet").parquet(
                f"{path}/out/trajets_nettoyes")
        with work_table(marts.rollup_trips(facts), "rollup") as rollup:
            parquet.write_marts(marts.build_marts(rollup), f"{path}/out")
        loaded, failed = warehouse.load_tables(spark, f"{path}/out", db)
        assert not failed
        warehouse.load_dim_zones(star.to_dim_zones(zone_lookup(spark, sf_dir)), db)
        frames = {name: spark.table(f"{db}.{name}") for name in [*loaded, "dim_zones"]}
        return held(warehouse.table_row_counts({**frames, "fact_trips": stored_star(spark, sf_dir)}))


_shared: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        path = place(spark, name)
        with settings(spark, SMALL), sized_for(spark, input_bytes(raw_trips(spark, sf_dir))):
            write(path)
        _shared[key] = path
    return _shared[key]


def stored_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(spark, sf_dir, "facts", lambda to: parquet.write_facts(
        enrich.to_facts(_by_date(spark, sf_dir)), to, laid_out=True))
    return tables.read_partitioned(spark, path)


def stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load(path: str) -> None:
        db = f"ridelake_{path.rsplit('-', 1)[1]}"
        spark.sql(f"CREATE SCHEMA {db} LOCATION '{path}'")
        warehouse.load_fact_trips(star.to_fact_trips(_by_date(spark, sf_dir), service_type()), db, laid_out=True)

    path = _once(spark, sf_dir, "star", load)
    return spark.table(f"ridelake_{path.rsplit('-', 1)[1]}.fact_trips")


def mart_from_rollup(name: str) -> Query:
    """A mart as the pipeline makes it: stored facts, rolled up, built from the rollup, written, read."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rollup = marts.rollup_trips(stored_facts(spark, sf_dir))
        with folder(spark, "mart") as path:
            parquet.write_marts({name: marts.build_marts(rollup)[name]}, path)
            return held(spark.read.parquet(f"{path}/{name}"))
    return query


def on_stored_star(report: Callable, *args, zones: bool = False) -> Query:
    """A report over the stored, partitioned star table."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dims = [star.to_dim_zones(zone_lookup(spark, sf_dir))] if zones else []
        return report(stored_star(spark, sf_dir), *dims, *args)
    return query


def stored_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.explore_preview(stored_facts(spark, sf_dir))


def sample_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source file after the first ten of each were written twice."""
    sources = [f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet"]
    with folder(spark, "sample") as path:
        for chosen in (sources[:1], sources):
            landing.write_sample(files.head_per_file(spark, chosen, 10), f"{path}/out")
        return held(spark.read.parquet(f"{path}/out").groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly files that the trips make, by name, and how many rows their footers tell. Sizes in bytes depend on the
    writer and are only said to be there."""
    month = F.date_format("pickup_datetime", "yyyy-MM").alias("month")
    with folder(spark, "listing") as path:
        trips = raw_trips(spark, sf_dir).where("pickup_datetime IS NOT NULL").select("trip_miles", month)
        trips.repartition("month").write.partitionBy("month").parquet(f"{path}/split")
        _as_files(spark, f"{path}/split", f"{path}/in")
        listed = files.list_files(spark, f"{path}/in", f"{DATASET}_*.parquet").select("path", "length")
        paths = sorted(row["path"] for row in listed.select("path").collect())
        told = footers.footers(spark, paths).select(files.file_name(F.col("path")).alias("name"), "rows")
        named = listed.select(files.file_name(F.col("path")).alias("name"), (F.col("length") > 0).alias("has_bytes"))
        return held(named.join(told, "name"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.profile(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def empty_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there are facts of a platform."""
    trips = enrich.to_facts(_enriched(spark, sf_dir))
    rows = [(name, explore.is_empty(trips.where(F.col("plateforme") == name))) for name in ("Uber", "Nobody")]
    return spark.createDataFrame(rows, "plateforme string, empty boolean")
