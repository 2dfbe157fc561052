"""The derived columns of a trip, each as an expression over the raw columns.

Codes and flags are compared as strings: a column without any value may come as an integer column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.functions.expressions import lookup
from ridelake.schema import DAYS_EN, DAYS_FR, OTHER_PLATFORM, PLATFORMS


def plateforme() -> Column:
    return lookup(F.col("hvfhs_license_num").cast("string"), PLATFORMS, OTHER_PLATFORM)


def duree_minutes() -> Column:
    return F.expr("round(trip_time / 60, 2)")


def temps_attente_min() -> Column:
    """Whole seconds between request and pickup; NULL when unknown or negative."""
    waited = F.expr("unix_timestamp(pickup_datetime) - unix_timestamp(request_datetime)")
    return F.when(waited >= 0, F.round(waited / 60, 2))


def vitesse_mph() -> Column:
    return F.expr("CASE WHEN trip_time > 0 THEN round(trip_miles / (trip_time / 3600), 2) END")


def revenu_total() -> Column:
    """Fare plus extras; a missing extra counts as nothing, a missing fare is not made up."""
    return F.expr(
        "round(base_passenger_fare + nvl(tolls, 0D) + nvl(congestion_surcharge, 0D)"
        " + nvl(airport_fee, 0D) + nvl(tips, 0D), 2)"
    )


def taux_reversement() -> Column:
    return F.expr("round(driver_pay / nullif(base_passenger_fare, 0D), 2)")


def a_pourboire() -> Column:
    return F.expr("nvl(tips > 0, false)")


def est_partagee() -> Column:
    return F.col("shared_match_flag").cast("string").eqNullSafe("Y")


def est_pmr() -> Column:
    return F.col("wav_request_flag").cast("string").eqNullSafe("Y")


def date_trajet() -> Column:
    return F.to_date("pickup_datetime")


def annee() -> Column:
    return F.year(date_trajet())


def mois() -> Column:
    return F.month(date_trajet())


def heure() -> Column:
    return F.hour("pickup_datetime")


def jour_semaine() -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(date_trajet())


def nom_jour() -> Column:
    """English name, picked by number: no date formatter runs per row."""
    return F.elt(jour_semaine(), *[F.lit(day) for day in DAYS_EN])


def est_weekend() -> Column:
    return F.coalesce(jour_semaine().isin(1, 7), F.lit(False))


def nom_jour_fr(number: Column | None = None) -> Column:
    """French weekday name of a weekday number; NULL for any other number."""
    key = F.col("jour_semaine") if number is None else number
    return lookup(key, dict(enumerate(DAYS_FR, start=1)))
