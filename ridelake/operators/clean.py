"""Row rules, full-row deduplication, and the reports about what they reject.

The rules are ANDed and a NULL operand drops the row. Deduplication compares all columns; Spark
collapses copies inside each map task before the shuffle, so that a group of copies of any size
sends one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from ridelake.functions.expressions import percent, settled
from ridelake.schema import MAX_TRIP_MILES, MAX_TRIP_SECONDS, MIN_TRIP_SECONDS


def has_both_times() -> Column:
    return F.expr("pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL")


def ends_after_start() -> Column:
    return F.expr("dropoff_datetime > pickup_datetime")


def plausible_time() -> Column:
    return F.col("trip_time").between(MIN_TRIP_SECONDS, MAX_TRIP_SECONDS)


def plausible_miles() -> Column:
    return F.expr(f"trip_miles > 0 AND trip_miles < {MAX_TRIP_MILES}")


def fare_not_negative() -> Column:
    """NaN passes: Spark orders it above every number."""
    return F.expr("base_passenger_fare >= 0")


# In the order in which the funnel applies them.
RULES = {
    "not_null": has_both_times,
    "time_order": ends_after_start,
    "trip_time": plausible_time,
    "trip_miles": plausible_miles,
    "fare": fare_not_negative,
}


def clean_dedup(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def clean_not_null(df: DataFrame) -> DataFrame:
    return df.where(has_both_times())


def clean_time_order(df: DataFrame) -> DataFrame:
    return df.where(ends_after_start())


def clean_trip_time(df: DataFrame) -> DataFrame:
    return df.where(plausible_time())


def clean_trip_miles(df: DataFrame) -> DataFrame:
    return df.where(plausible_miles())


def clean_fare(df: DataFrame) -> DataFrame:
    return df.where(fare_not_negative())


def passes_rules() -> Column:
    return reduce(Column.__and__, [rule() for rule in RULES.values()])


def clean_trips(raw: DataFrame) -> DataFrame:
    """All rules, then the distinct: only rows worth keeping are shuffled."""
    return clean_dedup(raw.where(passes_rules()))


def row_digest(df: DataFrame) -> Column:
    """256 bits that are equal for equal rows only (but for chance): values tagged by column, NULLs left out,
    -0.0 as 0.0 and every NaN alike, as the distinct compares them."""
    parts = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (FloatType, DoubleType)):
            value = value + F.lit(0.0)
        text = value.cast("string")
        if isinstance(field.dataType, StringType):
            text = F.replace(text, F.lit("|"), F.lit("||"))
        parts.append(F.concat(F.lit(f"{field.name}="), text))
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def clean_summary(raw: DataFrame) -> DataFrame:
    """One row: rows in, rows kept, percent rejected, and kept rows whose fare is NaN.

    The count of rows in needs no column, so Parquet answers it from the footers; counting in
    the same pass as the clean rows would keep the filters away from the scan. Both counts are
    query results rather than accumulators, which a rerun of a lost task would inflate.
    """
    total = raw.agg(F.count(F.lit(1)).alias("rows_in")).select(
        "rows_in", F.lit(0).cast("long").alias("rows_kept"), F.lit(0).cast("long").alias("rows_nan_fare"))
    kept = clean_trips(raw).agg(
        F.lit(0).cast("long").alias("rows_in"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.count_if(F.isnan("base_passenger_fare")).alias("rows_nan_fare"))
    both = total.union(kept).agg(*[
        F.sum(name).alias(name) for name in ("rows_in", "rows_kept", "rows_nan_fare")])
    rejected = F.col("rows_in") - F.col("rows_kept")
    return both.select(
        "rows_in", "rows_kept",
        settled(F.coalesce(percent(rejected, F.col("rows_in")), F.lit(0.0)), 1).alias("pct_rejected"),
        "rows_nan_fare")


def clean_funnel(raw: DataFrame) -> DataFrame:
    """Rows before and after each rule, in order, from one pass and one shuffle.

    What is shuffled is not the rows but their digests, with the number of rules a row passes in order; copies
    collapse in the map tasks. The group sizes add up to the raw count.
    """
    passed, level = F.lit(True), F.lit(0)
    for rule in RULES.values():
        passed = passed & F.coalesce(rule(), F.lit(False))
        level = level + passed.cast("int")
    distinct = raw.select(row_digest(raw).alias("__row"), level.cast("byte").alias("__level")).groupBy(
        "__row", "__level").agg(F.count(F.lit(1)).alias("__copies"))
    survivors = [(name, F.count_if(F.col("__level") > i)) for i, name in enumerate(RULES)]
    counts = distinct.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("raw"),
        F.count(F.lit(1)).alias("dedup"),
        *[count.alias(name) for name, count in survivors])
    steps = ["raw", "dedup", *RULES]
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(before).alias("rows_before"),
                 F.col(rule).alias("rows_after"))
        for before, rule in zip(steps, steps[1:])])))
