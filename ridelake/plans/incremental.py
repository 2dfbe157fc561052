"""Facts, rollup and marts kept up to date with the lake: only what changed files touch is computed again.

Copies of a trip have the same date, so each date can be computed by itself and the distinct stays right. An index tells
which landed version of which file has trips of which dates. From it and the lake's manifest follow:

* *fresh* files, whose version the index does not know; they alone are read to learn their dates;
* *touched* dates: those of fresh files, and those the index has for versions that are no longer current;
* for these dates, the files to read: all current ones that have trips of them. Other files are not opened.

The touched dates' facts replace their partitions, then the rollup of these dates is computed from their facts and
replaces its own partitions; marts merge the whole rollup, which is bounded by dates and dimensions. Older dates' facts
are neither read nor written. The index is written last, to a new folder that a commit names: a run that dies before has
the same dates to do again.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.clean import clean_trips, passes_rules
from ridelake.operators.enrich import enrich_by_date, to_facts
from ridelake.operators.marts import GRAIN, build_marts, merge_rollup, rollup_trips
from ridelake.schema import FACT_PARTITION, FACT_TABLE
from ridelake.session import input_bytes, pin_utc, sized_for, work_table
from ridelake.sinks.parquet import write_marts
from ridelake.sources.files import SOURCE_FILE, existing
from ridelake.sources.landing import MOST_NAMED, VERSION, last_commit, manifest, read_lake, try_commit

log = logging.getLogger(__name__)

ROLLUP = "rollup_par_date"
# Leading underscores hide the index from readers of the folder.
INDEX = "_dates"
INDEX_SCHEMA = f"name string, {VERSION} string, {FACT_PARTITION} date"


@dataclass
class Refresh:
    """What a refresh did: files it read for the first time, dates it computed, files it read for them, dates that are
    gone, and the paths of the tables."""

    fresh: list[str] = field(default_factory=list)
    dates: list = field(default_factory=list)
    read: list[str] = field(default_factory=list)
    removed: list = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)


def index(spark: SparkSession, out: str) -> DataFrame:
    """(name, version, date) of the last refresh that was completed."""
    number = last_commit(spark, f"{out}/{INDEX}")
    if not number:
        return spark.createDataFrame([], INDEX_SCHEMA)
    at = f"{out}/{INDEX}/_manifest/commits/{number:020d}"
    body = spark.read.text(at, wholetext=True).first()["value"]
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{out}/{INDEX}/{body}")


def _dates_of(spark: SparkSession, lake: str, fresh: DataFrame) -> DataFrame:
    """(name, version, date) of the files' trips, and a row without date for each file, so that it is known."""
    trips = read_lake(spark, lake, fresh, keep_place=True)
    dates = trips.select(F.col(SOURCE_FILE).alias("name"), VERSION, F.to_date("pickup_datetime").alias(FACT_PARTITION))
    return dates.distinct().union(fresh.select("name", VERSION, F.lit(None).cast("date"))).distinct()


def _drop_dates(spark: SparkSession, table: str, dates: list) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for date in dates:
        at = path(f"{table}/{FACT_PARTITION}={date}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _replace(rows: DataFrame, table: str) -> None:
    """Overwrite only the dates that ``rows`` have."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FACT_PARTITION)
     .parquet(table))


def rollup_by_date(facts: DataFrame) -> DataFrame:
    """``rollup_trips`` with the date as one more key; its rows add up to the rollup of all dates."""
    return rollup_trips(facts, [FACT_PARTITION, *GRAIN])


def refresh(spark: SparkSession, lake: str, out: str) -> Refresh:
    """Bring facts, rollup and marts under ``out`` up to date with the lake. The first refresh computes everything."""
    pin_utc(spark)
    done = Refresh()
    facts_path, rollup_path = f"{out}/{FACT_TABLE}", f"{out}/{ROLLUP}"
    number = last_commit(spark, f"{out}/{INDEX}")
    known, current = index(spark, out), manifest(spark, lake)
    fresh = current.select("name", VERSION).join(known, ["name", VERSION], "left_anti")
    with work_table(fresh, "fresh") as fresh:
        done.fresh = [row["name"] for row in fresh.orderBy("name").collect()]
        gone = known.join(current, ["name", VERSION], "left_anti")
        learnt = _dates_of(spark, lake, fresh) if done.fresh else spark.createDataFrame([], INDEX_SCHEMA)
        with work_table(learnt, "learnt") as learnt:
            whole = known.join(current, ["name", VERSION], "left_semi").unionByName(learnt)
            touched = learnt.unionByName(gone).select(FACT_PARTITION).where(F.col(FACT_PARTITION).isNotNull()).distinct()
            with work_table(touched, "touched") as touched, work_table(whole, "dates") as whole:
                done.dates = [row[0] for row in touched.orderBy(FACT_PARTITION).collect()]
                if done.dates:
                    _recompute(spark, lake, whole, touched, facts_path, rollup_path, done)
                if done.dates or done.fresh or not number:
                    body = uuid.uuid4().hex
                    whole.coalesce(1).write.parquet(f"{out}/{INDEX}/{body}")
                    if not try_commit(spark, f"{out}/{INDEX}", number + 1, body):
                        raise RuntimeError(f"another refresh of {out} has run at the same time")
    rolled = existing(lambda: spark.read.parquet(rollup_path))
    done.paths = {FACT_TABLE: facts_path, ROLLUP: rollup_path}
    if rolled is not None and (done.dates or not number):
        with work_table(merge_rollup(rolled), "rollup") as merged:
            done.paths.update(write_marts(build_marts(merged), out))
    log.info("%d fresh file(s), %d date(s) computed from %d file(s)", len(done.fresh), len(done.dates), len(done.read))
    return done


def _recompute(spark: SparkSession, lake: str, whole: DataFrame, touched: DataFrame, facts_path: str,
               rollup_path: str, done: Refresh) -> None:
    """Facts and rollup of the touched dates, from the files that have trips of them."""
    wanted = whole.join(touched, FACT_PARTITION, "left_semi").select("name", VERSION).distinct()
    done.read = [row["name"] for row in wanted.orderBy("name").collect()]
    kept = set()
    if done.read:
        trips = read_lake(spark, lake, wanted)
        day = F.to_date("pickup_datetime")
        trips = trips.join(touched.select(F.col(FACT_PARTITION).alias("__day")), day == F.col("__day"), "left_semi")
        # A date is left if a trip of it passes the rules; for that no row need be moved.
        left = trips.where(passes_rules()).select(day.alias(FACT_PARTITION)).distinct()
        kept = {row[0] for row in left.collect()}
    # Dates of which nothing is left have no rows that would replace their partitions.
    done.removed = [date for date in done.dates if date not in kept]
    for table in (facts_path, rollup_path):
        _drop_dates(spark, table, done.removed)
    if kept:
        with sized_for(spark, input_bytes(trips)):
            facts = to_facts(enrich_by_date(clean_trips(trips)))
            _replace(facts.sortWithinPartitions(FACT_PARTITION, "PULocationID"), facts_path)
        facts = spark.read.parquet(facts_path)
        if len(kept) <= MOST_NAMED:  # then the folders of other dates are not even listed as tasks
            facts = facts.where(F.col(FACT_PARTITION).isin(sorted(kept)))
        else:
            facts = facts.join(touched, FACT_PARTITION, "left_semi")
        _replace(rollup_by_date(facts).hint("rebalance", FACT_PARTITION), rollup_path)
