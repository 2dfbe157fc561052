"""Writing facts, marts and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.schema import FACT_PARTITION


def interleaved(*columns: str, bits: int = 16) -> Column:
    """Order of rows that keeps rows near each other that are near in all of two to three whole-number columns: their
    lowest ``bits`` bits taken in turn, the highest first. Row groups of rows in this order have narrow ranges in every
    column, so a filter on any of them skips. Numbers of ``2**bits`` and more share the last place; nulls come first."""
    places = [F.least(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)), F.lit(2**bits - 1)).cast("long") for c in columns]
    order = F.lit(0).cast("long")
    for bit in range(bits):
        for at, place in enumerate(reversed(places)):
            order = order.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)), bit * len(places) + at))
    return order


def spread(df: DataFrame, partition: str, *cluster: str | Column) -> DataFrame:
    """Lay rows out for a write partitioned by ``partition``.

    The rebalance brings the rows of a date together, which keeps the number of files low, but
    lets AQE split a date that is too large for one task and merge dates that are too small. Rows
    are then sorted inside each task by the clustering columns, so that readers can skip row groups.
    """
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *cluster)


def write_facts(facts: DataFrame, path: str, laid_out: bool = False) -> None:
    """Replace the fact table, partitioned by trip date and clustered by pickup zone. Rows that are ``laid_out`` by date
    already are sorted within tasks and not shuffled."""
    rows = facts.sortWithinPartitions(FACT_PARTITION, "PULocationID") if laid_out else spread(
        facts, FACT_PARTITION, "PULocationID")
    (rows.write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(FACT_PARTITION).parquet(path))


def write_marts(marts: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Replace each mart by one file; a mart is bounded by its keys, and the work is done before
    its rows meet in one task."""
    paths = {}
    for name, mart in marts.items():
        paths[name] = f"{base}/{name}"
        mart.coalesce(1).write.mode("overwrite").parquet(paths[name])
    return paths


def export_csv(df: DataFrame, path: str) -> None:
    """Export rows with a header, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
