"""Small column builders shared by several operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(key: Column, values: Mapping[object, object], default: object = None) -> Column:
    """``CASE key WHEN …`` over a small mapping, ``default`` for anything else and for NULL."""
    first, *rest = values.items()
    chain = F.when(key == first[0], F.lit(first[1]))
    for candidate, value in rest:
        chain = chain.when(key == candidate, F.lit(value))
    return chain.otherwise(F.lit(default))


def settled(value: Column, digits: int) -> Column:
    """Round an aggregate of doubles so that the order of summation cannot show.

    The order in which partitions are added up differs from run to run, so a mean that lies on
    a rounding boundary may fall on either side. Cutting to ten decimals first removes that
    noise. NaN, infinities and values too large for the decimal are rounded as doubles.
    """
    cut = value.try_cast("decimal(38,10)")
    return F.coalesce(F.round(cut, digits).cast("double"), F.round(value, digits))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double, NULL when there is no whole."""
    return part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0))


def in_range(column: Column, start: object, end: object) -> Column:
    """Closed date range on a date column, in a form that prunes partitions."""
    return column.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
