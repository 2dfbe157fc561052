"""Filters of an exploration session over the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.expressions import in_range

ALL_DAYS, WEEKDAYS, WEEKEND = "all", "week", "weekend"


@dataclass(frozen=True)
class Filters:
    """A selection; the defaults keep everything (``platforms=None`` means all of them)."""

    platforms: Sequence[str] | None = None
    start: object = None
    end: object = None
    first_hour: int = 0
    last_hour: int = 23
    day_type: str = ALL_DAYS
    shared_only: bool = False
    wav_only: bool = False
    boroughs: Sequence[str] = ()


def filter_platform(facts: DataFrame, platforms: Sequence[str]) -> DataFrame:
    """Nothing selected means no rows."""
    return facts.where(F.col("plateforme").isin(*platforms) if platforms else F.lit(False))


def filter_dates(facts: DataFrame, start: object, end: object) -> DataFrame:
    """Closed range, applied only when both ends are given; prunes date partitions."""
    if start is None or end is None:
        return facts
    return facts.where(in_range(F.col("date_trajet"), start, end))


def filter_hours(facts: DataFrame, first: int, last: int) -> DataFrame:
    return facts.where(F.col("heure").between(first, last))


def filter_daytype(facts: DataFrame, day_type: str) -> DataFrame:
    if day_type == ALL_DAYS:
        return facts
    if day_type not in (WEEKDAYS, WEEKEND):
        raise ValueError(f"unknown day type {day_type!r}")
    weekend = F.col("est_weekend")
    return facts.where(weekend if day_type == WEEKEND else ~weekend)


def filter_shared(facts: DataFrame, only: bool) -> DataFrame:
    return facts.where("est_partagee") if only else facts


def filter_wav(facts: DataFrame, only: bool) -> DataFrame:
    return facts.where("est_pmr") if only else facts


def filter_borough(facts: DataFrame, zones: DataFrame | None, boroughs: Sequence[str]) -> DataFrame:
    """Trips that start in one of the boroughs; nothing selected or no zones means no filter.

    There is no broadcast hint: Spark broadcasts the zone ids when their measured size is below
    its threshold, and otherwise joins by shuffle with skewed keys split.
    """
    if zones is None or not boroughs:
        return facts
    wanted = zones.where(F.col("arrondissement").isin(*boroughs))
    return facts.join(wanted, facts["PULocationID"] == wanted["zone_id"], "left_semi")


def apply_filters(facts: DataFrame, zones: DataFrame | None, chosen: Filters) -> DataFrame:
    """All filters of a selection as one plan."""
    kept = facts if chosen.platforms is None else filter_platform(facts, chosen.platforms)
    kept = filter_dates(kept, chosen.start, chosen.end)
    kept = filter_hours(kept, chosen.first_hour, chosen.last_hour)
    kept = filter_daytype(kept, chosen.day_type)
    kept = filter_shared(kept, chosen.shared_only)
    kept = filter_wav(kept, chosen.wav_only)
    return filter_borough(kept, zones, chosen.boroughs)
