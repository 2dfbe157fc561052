"""Derived columns in groups, all of them at once, and the fact projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ridelake.functions import trip
from ridelake.schema import DERIVED_COLUMNS, FACT_COLUMNS, FACT_PARTITION


def _add(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: getattr(trip, name)() for name in names})


def enrich_platform(df: DataFrame) -> DataFrame:
    return _add(df, "plateforme")


def enrich_duration(df: DataFrame) -> DataFrame:
    return _add(df, "duree_minutes")


def enrich_wait(df: DataFrame) -> DataFrame:
    return _add(df, "temps_attente_min")


def enrich_speed(df: DataFrame) -> DataFrame:
    return _add(df, "vitesse_mph")


def enrich_revenue(df: DataFrame) -> DataFrame:
    return _add(df, "revenu_total")


def enrich_payout(df: DataFrame) -> DataFrame:
    return _add(df, "taux_reversement")


def enrich_flags(df: DataFrame) -> DataFrame:
    return _add(df, "a_pourboire", "est_partagee", "est_pmr")


def enrich_calendar(df: DataFrame) -> DataFrame:
    return _add(df, "date_trajet", "annee", "mois", "heure", "jour_semaine", "nom_jour", "est_weekend")


def enrich_trips(clean: DataFrame) -> DataFrame:
    """All derived columns in one projection."""
    return _add(clean, *DERIVED_COLUMNS)


def enrich_by_date(clean: DataFrame) -> DataFrame:
    """All derived columns of trips that are brought together by date, for a write partitioned by it.

    The rebalance comes first, so what is shuffled are the raw columns that the plan needs, and the wider derived ones
    never are. AQE splits large dates over tasks and merges small ones.
    """
    return enrich_trips(_add(clean, FACT_PARTITION).hint("rebalance", FACT_PARTITION))


def to_facts(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)
