"""Exploration queries over the fact table (or a filtered part of it).

Only aggregates leave the cluster. Measures that are shown unrounded are settled at six decimals,
which is far below what a display shows and makes runs comparable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions.expressions import percent, settled
from ridelake.functions.trip import nom_jour_fr
from ridelake.schema import FACT_COLUMNS

EXACT = 6
TOP_ZONES = 15
PREVIEW_ROWS = 2000


def _trips() -> Column:
    return F.count(F.lit(1)).alias("nombre_trajets")


def _value(name: str) -> Column:
    """A measure whose NaN, like NULL, counts for nothing in sums and means."""
    return F.when(~F.isnan(name), F.col(name))


def _share(flag: str) -> Column:
    return F.lit(100.0) * F.avg(F.col(flag).cast("int"))


def facts_with_day_fr(facts: DataFrame) -> DataFrame:
    return facts.withColumn("nom_jour_fr", nom_jour_fr())


def is_empty(facts: DataFrame) -> bool:
    return facts.isEmpty()


def explore_kpis(facts: DataFrame) -> DataFrame:
    """The indicator band: one row."""
    return facts.agg(
        _trips(),
        settled(F.sum(_value("revenu_total")), EXACT).alias("revenu_total"),
        settled(F.avg(_value("revenu_total")), EXACT).alias("revenu_moyen"),
        settled(F.avg(_value("tips")), EXACT).alias("pourboire_moyen"),
        settled(F.avg(_value("taux_reversement")), EXACT).alias("taux_reversement_moyen"),
        settled(F.avg(_value("trip_miles")), EXACT).alias("distance_moyenne"),
        settled(F.avg(_value("duree_minutes")), EXACT).alias("duree_moyenne_min"),
        settled(F.avg(_value("temps_attente_min")), EXACT).alias("temps_attente_moyen_min"),
        settled(_share("est_partagee"), EXACT).alias("part_partagee"),
        settled(_share("est_pmr"), EXACT).alias("part_pmr"))


def explore_platform_share(facts: DataFrame) -> DataFrame:
    """Trips, share of all trips and mean revenue per platform, largest first.

    The window runs over one row per platform, after the aggregation.
    """
    everything = Window.partitionBy()
    return (
        facts.groupBy("plateforme")
        .agg(_trips(), settled(F.avg(_value("revenu_total")), EXACT).alias("revenu_moyen"))
        .withColumn("part_pct", settled(
            percent(F.col("nombre_trajets"), F.sum("nombre_trajets").over(everything)), EXACT))
        .select("plateforme", "nombre_trajets", "part_pct", "revenu_moyen")
        .orderBy(F.desc("nombre_trajets"), "plateforme"))


def explore_platform_means(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("plateforme")
        .agg(_trips(),
             settled(F.avg(_value("revenu_total")), 2).alias("revenu_moyen"),
             settled(F.avg(_value("tips")), 2).alias("pourboire_moyen"),
             settled(F.avg(_value("vitesse_mph")), 2).alias("vitesse_moyenne_mph"),
             settled(F.avg(_value("temps_attente_min")), 2).alias("temps_attente_moyen_min"))
        .orderBy("plateforme"))


def explore_by_hour(facts: DataFrame) -> DataFrame:
    return facts.groupBy("heure", "plateforme").agg(_trips()).orderBy("heure", "plateforme")


def explore_by_weekday(facts: DataFrame) -> DataFrame:
    """The French name is a function of the number, so it is added to the groups, not to the trips."""
    return (
        facts.groupBy("jour_semaine", "plateforme").agg(_trips())
        .select("jour_semaine", nom_jour_fr().alias("nom_jour_fr"), "plateforme", "nombre_trajets")
        .where("nom_jour_fr IS NOT NULL")
        .orderBy("jour_semaine", "plateforme"))


def explore_by_month(facts: DataFrame) -> DataFrame:
    """Revenue by ``YYYY-MM`` and platform."""
    month = F.concat_ws("-", F.col("annee").cast("string"), F.lpad(F.col("mois").cast("string"), 2, "0"))
    return (
        facts.groupBy("annee", "mois", "plateforme")
        .agg(settled(F.sum(_value("revenu_total")), 2).alias("revenu_total"))
        .select(month.alias("annee_mois"), "plateforme", "revenu_total")
        .orderBy("annee_mois", "plateforme"))


def explore_by_zone(facts: DataFrame) -> DataFrame:
    """Trips and revenue by pickup zone; trips without a zone are left out."""
    return (
        facts.where(F.col("PULocationID").isNotNull())
        .groupBy(F.col("PULocationID").alias("zone_id"))
        .agg(_trips(),
             settled(F.sum(_value("revenu_total")), 2).alias("revenu_total"),
             settled(F.avg(_value("revenu_total")), 2).alias("revenu_moyen")))


def explore_zone_labels(facts: DataFrame, zones: DataFrame | None) -> DataFrame:
    """Zone rows with a readable label; without a zone dimension the label is the zone number.

    The dimension meets one row per zone, not the trips.
    """
    by_zone = explore_by_zone(facts)
    number = F.concat(F.lit("Zone "), F.col("zone_id").cast("string"))
    if zones is None:
        return by_zone.withColumn("libelle", number)
    label = F.concat(
        F.coalesce(F.col("zone_nom"), number), F.lit(" ("),
        F.coalesce(F.col("arrondissement"), F.lit("?")), F.lit(")"))
    return by_zone.join(zones, "zone_id", "left").withColumn("libelle", label)


def explore_top15(facts: DataFrame, zones: DataFrame | None, n: int = TOP_ZONES) -> DataFrame:
    return (
        explore_zone_labels(facts, zones)
        .select("zone_id", "libelle", "nombre_trajets")
        .orderBy(F.desc("nombre_trajets"), "zone_id", "libelle")
        .limit(n))


def explore_zone_table(facts: DataFrame, zones: DataFrame | None) -> DataFrame:
    return (
        explore_zone_labels(facts, zones)
        .select("zone_id", "libelle", "nombre_trajets", "revenu_total", "revenu_moyen")
        .orderBy(F.desc("revenu_total"), "zone_id", "libelle"))


def explore_preview(facts: DataFrame, ordered: bool = True, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` trips. Unordered, Spark stops as soon as it has enough of them.

    Ordered, the answer is repeatable and reads few dates: trips are counted by date, which needs the partition
    column only; the first date by which there are enough bounds the scan, and only its tasks' first rows meet.
    """
    if not ordered:
        return facts.limit(n)
    # One row per date, so the running count is over thousands of rows however many trips there are.
    per_date = facts.where("date_trajet IS NOT NULL").groupBy("date_trajet").agg(F.count(F.lit(1)).alias("trips"))
    so_far = per_date.select("date_trajet", F.sum("trips").over(Window.orderBy("date_trajet")).alias("so_far"))
    last = so_far.agg(F.coalesce(
        F.min(F.when(F.col("so_far") >= n, F.col("date_trajet"))), F.max("date_trajet")).alias("last"))
    rest = [name for name in FACT_COLUMNS if name != "date_trajet"]
    near = facts.where((F.col("date_trajet") <= last.scalar()) | F.col("date_trajet").isNull())
    return near.orderBy("date_trajet", *rest).limit(n)


def explore_row_count(facts: DataFrame) -> DataFrame:
    """The number of trips that goes with the preview."""
    return facts.agg(_trips())


def explore_domains(facts: DataFrame, zones: DataFrame | None) -> DataFrame:
    """What the filters can be set to, as sorted ``(domaine, valeur)``.

    One pass over the trips: a group per platform, whose date bounds are then combined.
    """
    per_platform = facts.groupBy("plateforme").agg(
        F.min("date_trajet").alias("first"), F.max("date_trajet").alias("last"))
    bounds = per_platform.agg(
        F.collect_set("plateforme").alias("platforms"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    dates = F.array_compact(F.array(F.col("first").cast("string"), F.col("last").cast("string")))
    found = bounds.select(F.explode(F.create_map(
        F.lit("plateforme"), F.col("platforms"), F.lit("date"), dates)).alias("domaine", "valeurs")
    ).select("domaine", F.explode("valeurs").alias("valeur"))
    if zones is not None:
        boroughs = zones.select("arrondissement").where("arrondissement IS NOT NULL").distinct()
        found = found.union(boroughs.select(F.lit("arrondissement"), "arrondissement"))
    return found.orderBy("domaine", "valeur")
