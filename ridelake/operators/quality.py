"""Constraints that Parquet tables do not enforce by themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_REQUIRED = ["trip_id", "pickup_datetime", "dropoff_datetime"]
ZONE_REQUIRED = ["location_id"]


class ConstraintViolation(ValueError):
    """A required column holds NULL."""


class MissingPartitionFilter(ValueError):
    """A query would read every partition of a partitioned table."""


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column with its number of NULLs, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).alias("violations")) for name in columns])))


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise if a required column holds NULL, else return ``df``."""
    broken = check_not_null(df, columns).where("violations > 0").collect()
    if broken:
        raise ConstraintViolation(", ".join(f"{row.column}: {row.violations} NULL" for row in broken))
    return df


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` whose required columns fail the running job on a NULL: no pass of its own."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.raise_error(F.lit(f"NULL in required column {name}")))
        for name in columns})


_COMPARES = {"EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual", "GreaterThan", "GreaterThanOrEqual",
             "In", "InSet"}
# Leaves that hold rows already, or none: there are no partitions to prune.
_NO_FILES = {"LocalTableScanExec", "RangeExec", "RDDScanExec", "OneRowRelationExec", "EmptyRelationExec"}


def _each(collection):
    return [collection.apply(i) for i in range(collection.size())]


def _bounds(expression) -> bool:
    """Whether a filter restricts the values of a column: not merely that there is one."""
    kind = expression.getClass().getSimpleName()
    children = [_bounds(child) for child in _each(expression.children())] if kind in ("And", "Or") else []
    if kind == "And":
        return any(children)
    if kind == "Or":
        return all(children)
    return kind in _COMPARES


def _check_plan(plan) -> None:
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _check_plan(plan.initialPlan())
    for subquery in _each(plan.subqueries()):
        _check_plan(subquery)
    children = _each(plan.children())
    for child in children:
        _check_plan(child)
    if children:
        return
    if kind == "InMemoryTableScanExec":
        return _check_plan(plan.relation().cachedPlan())
    if kind in ("SubqueryExec", "SubqueryBroadcastExec", "ReusedSubqueryExec"):
        return _check_plan(plan.child())
    if kind == "FileSourceScanExec":
        columns, filters = plan.relation().partitionSchema(), plan.partitionFilters()
    elif kind == "BatchScanExec" and hasattr(plan.scan(), "readPartitionSchema"):
        columns, filters = plan.scan().fileIndex().partitionSchema(), plan.scan().partitionFilters()
    elif kind in _NO_FILES:
        return
    else:
        raise MissingPartitionFilter(f"cannot tell what is read by {kind}")
    if not columns.isEmpty() and not any(_bounds(f) for f in _each(filters)):
        raise MissingPartitionFilter(
            f"filter on the partition column is required: {', '.join(columns.fieldNames())}")


def require_partition_filter(df: DataFrame) -> DataFrame:
    """Refuse a plan that scans a partitioned table without bounding a partition column.

    Subqueries, cached frames and both Parquet readers are looked into; a scan of unknown kind is refused. A
    comparison, ``IN`` or range bounds a column, ``IS NOT NULL`` does not.
    """
    _check_plan(df._jdf.queryExecution().executedPlan())
    return df
