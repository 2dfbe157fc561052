"""Aggregate marts over enriched trips or over facts.

A mart is a ``Mart``: its keys, its measures and its order. Every measure is a total or a mean, so
it can be computed from sums and counts. That gives two ways to the same numbers:

* ``build(mart, trips)`` aggregates the trips directly, for one mart on its own;
* ``rollup_trips(trips)`` reads the trips once and keeps sums and counts at the finest grain any
  mart needs; every mart is then an aggregate of that rollup. Its size is bounded by the
  dimensions (platforms x months x weekdays x hours x zones), not by the number of trips.

All aggregates combine inside the map tasks, so a hot platform, day or zone sends one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.expressions import settled

TOTAL, MEAN, SHARE = "total", "mean", "share"


@dataclass(frozen=True)
class Measure:
    name: str
    column: str
    kind: str


@dataclass(frozen=True)
class Mart:
    name: str
    keys: dict[str, str]
    measures: tuple[Measure, ...]
    order: tuple[str, ...] = ()
    largest_first: bool = False


REVENUE_TOTAL = Measure("revenu_total", "revenu_total", TOTAL)
REVENUE_MEAN = Measure("revenu_moyen", "revenu_total", MEAN)
MILES_MEAN = Measure("distance_moyenne", "trip_miles", MEAN)
DURATION_MEAN = Measure("duree_moyenne_min", "duree_minutes", MEAN)
WAIT_MEAN = Measure("temps_attente_moyen_min", "temps_attente_min", MEAN)

KPI = (
    REVENUE_TOTAL,
    REVENUE_MEAN,
    Measure("pourboire_moyen", "tips", MEAN),
    Measure("taux_reversement_moyen", "taux_reversement", MEAN),
    MILES_MEAN,
    DURATION_MEAN,
    WAIT_MEAN,
    Measure("vitesse_moyenne_mph", "vitesse_mph", MEAN),
    Measure("part_partagee", "est_partagee", SHARE),
    Measure("part_pmr", "est_pmr", SHARE),
)

MARTS = {
    mart.name: mart
    for mart in (
        Mart("kpi_globaux", {}, KPI),
        Mart("kpi_par_plateforme", {"plateforme": "plateforme"}, KPI, largest_first=True),
        Mart("trajets_par_heure", {"heure": "heure", "plateforme": "plateforme"},
             (REVENUE_MEAN, DURATION_MEAN, WAIT_MEAN), ("heure", "plateforme")),
        Mart("trajets_par_jour_semaine",
             {key: key for key in ("jour_semaine", "nom_jour", "est_weekend", "plateforme")},
             (REVENUE_MEAN,), ("jour_semaine", "plateforme")),
        Mart("trajets_par_annee_mois",
             {key: key for key in ("annee", "mois", "plateforme")},
             (REVENUE_TOTAL, REVENUE_MEAN, MILES_MEAN), ("annee", "mois", "plateforme")),
        Mart("revenu_par_zone_depart", {"zone_id": "PULocationID", "plateforme": "plateforme"},
             (REVENUE_TOTAL, REVENUE_MEAN, MILES_MEAN), largest_first=True),
    )
}

ROWS = "__rows"
GRAIN = sorted({column for mart in MARTS.values() for column in mart.keys.values()})
MEASURED = sorted({measure.column for measure in KPI})


def _sum(column: str) -> str:
    return f"{column}__sum"


def _count(column: str) -> str:
    return f"{column}__count"


def _is_rollup(df: DataFrame) -> bool:
    return ROWS in df.columns


def _number(column: str) -> Column:
    """Flags are measured as 0/1, everything else as it is."""
    flags = {measure.column for measure in KPI if measure.kind == SHARE}
    return F.col(column).cast("int") if column in flags else F.col(column)


def rollup_trips(trips: DataFrame, keys: list[str] = GRAIN) -> DataFrame:
    """Sums and non-null counts of every measured column at the finest grain of the marts, or at a finer one."""
    parts = [F.count(F.lit(1)).alias(ROWS)]
    for column in MEASURED:
        parts += [F.sum(_number(column)).alias(_sum(column)),
                  F.count(column).alias(_count(column))]
    return trips.groupBy(*keys).agg(*parts)


def merge_rollup(rollup: DataFrame) -> DataFrame:
    """A rollup at a finer grain, added up to the grain of the marts."""
    parts = [name for column in MEASURED for name in (_sum(column), _count(column))]
    return rollup.groupBy(*GRAIN).agg(*[F.sum(name).alias(name) for name in (ROWS, *parts)])


def _measure(measure: Measure, rolled: bool) -> Column:
    if rolled:
        total, known = F.sum(_sum(measure.column)), F.sum(_count(measure.column))
    else:
        total, known = F.sum(_number(measure.column)), F.count(measure.column)
    if measure.kind == TOTAL:
        return settled(total, 2).alias(measure.name)
    mean = total / F.nullif(known, F.lit(0))
    if measure.kind == SHARE:
        mean = F.lit(100.0) * mean
    return settled(mean, 2).alias(measure.name)


def _trip_count(rolled: bool) -> Column:
    rows = F.coalesce(F.sum(ROWS), F.lit(0)) if rolled else F.count(F.lit(1))
    return rows.alias("nombre_trajets")


def kpi_exprs() -> list[Column]:
    """The shared indicators as aggregates over trips."""
    return [_trip_count(False), *[_measure(measure, False) for measure in KPI]]


def build(mart: Mart, source: DataFrame) -> DataFrame:
    """One mart from trips or from their rollup."""
    rolled = _is_rollup(source)
    measures = [_trip_count(rolled), *[_measure(measure, rolled) for measure in mart.measures]]
    keys = [F.col(column).alias(name) for name, column in mart.keys.items()]
    table = source.groupBy(*keys).agg(*measures)
    if mart.largest_first:
        # The keys settle ties, so that the order is the same in every run.
        return table.orderBy(F.desc("nombre_trajets"), *mart.keys)
    return table.orderBy(*mart.order) if mart.order else table


def build_marts(source: DataFrame) -> dict[str, DataFrame]:
    """All six marts as lazy plans over one parent; give it a materialised rollup at scale."""
    return {name: build(mart, source) for name, mart in MARTS.items()}


def kpi_globaux(source: DataFrame) -> DataFrame:
    return build(MARTS["kpi_globaux"], source)


def kpi_par_plateforme(source: DataFrame) -> DataFrame:
    return build(MARTS["kpi_par_plateforme"], source)


def trajets_par_heure(source: DataFrame) -> DataFrame:
    return build(MARTS["trajets_par_heure"], source)


def trajets_par_jour_semaine(source: DataFrame) -> DataFrame:
    return build(MARTS["trajets_par_jour_semaine"], source)


def trajets_par_annee_mois(source: DataFrame) -> DataFrame:
    return build(MARTS["trajets_par_annee_mois"], source)


def revenu_par_zone_depart(source: DataFrame) -> DataFrame:
    return build(MARTS["revenu_par_zone_depart"], source)


def platform_counts(trips: DataFrame) -> DataFrame:
    """How often each platform occurs, most frequent first."""
    return (trips.groupBy("plateforme").agg(F.count(F.lit(1)).alias("nombre_trajets"))
            .orderBy(F.desc("nombre_trajets"), "plateforme"))
