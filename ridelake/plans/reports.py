"""Reports over the star schema, each for a closed range of pickup dates.

They filter on ``pickup_date``, the stored partition column, so that only the asked-for days are
read. Zone names are joined after the trips have been aggregated by zone id: what meets the
dimension is one row per zone or pair of zones, however many trips there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.expressions import in_range, percent, settled
from ridelake.operators.quality import require_partition_filter

TOP_ZONES = 20


def _trips() -> Column:
    return F.count(F.lit(1)).alias("nb_courses")


def _between(fact_trips: DataFrame, start: object, end: object) -> DataFrame:
    return require_partition_filter(fact_trips.where(in_range(F.col("pickup_date"), start, end)))


def report_daily(fact_trips: DataFrame, start: object, end: object) -> DataFrame:
    """Trips per day with mean distance and amount."""
    return (
        _between(fact_trips, start, end)
        .groupBy(F.col("pickup_date").alias("jour"))
        .agg(_trips(),
             settled(F.avg("trip_miles"), 2).alias("distance_moyenne_miles"),
             settled(F.avg("total_amount"), 2).alias("montant_moyen_usd"))
        .orderBy("jour"))


def report_heatmap(fact_trips: DataFrame, start: object, end: object) -> DataFrame:
    """Demand by weekday and hour."""
    return (
        _between(fact_trips, start, end)
        .groupBy(F.col("pickup_dayofweek").alias("jour_semaine"), F.col("pickup_hour").alias("heure"))
        .agg(_trips(), settled(F.avg("trip_duration_min"), 1).alias("duree_moyenne_min"))
        .orderBy("jour_semaine", "heure"))


def report_top_zones(fact_trips: DataFrame, dim_zones: DataFrame, start: object, end: object,
                     n: int = TOP_ZONES) -> DataFrame:
    """The ``n`` pickup zones with most trips; names settle ties."""
    by_id = (
        _between(fact_trips, start, end)
        .groupBy("pickup_location_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount")))
    return (
        by_id.join(dim_zones, by_id["pickup_location_id"] == dim_zones["location_id"])
        .groupBy(F.col("borough").alias("arrondissement"), F.col("zone_name").alias("zone"))
        .agg(F.sum("n").alias("nb_courses"), settled(F.sum("amount"), 2).alias("revenu_total_usd"))
        .orderBy(F.desc("nb_courses"), "zone", "arrondissement")
        .limit(n))


def report_top_od(fact_trips: DataFrame, dim_zones: DataFrame, start: object, end: object,
                  n: int = TOP_ZONES) -> DataFrame:
    """The ``n`` busiest origin-destination pairs; names settle ties."""
    by_ids = (
        _between(fact_trips, start, end)
        .groupBy("pickup_location_id", "dropoff_location_id")
        .agg(F.count(F.lit(1)).alias("n"),
             F.sum("trip_miles").alias("miles"), F.count("trip_miles").alias("miles_n"),
             F.sum("total_amount").alias("amount"), F.count("total_amount").alias("amount_n")))
    start_zones = dim_zones.select(
        F.col("location_id").alias("pickup_location_id"), F.col("zone_name").alias("zone_depart"))
    end_zones = dim_zones.select(
        F.col("location_id").alias("dropoff_location_id"), F.col("zone_name").alias("zone_arrivee"))
    return (
        by_ids.join(start_zones, "pickup_location_id").join(end_zones, "dropoff_location_id")
        .groupBy("zone_depart", "zone_arrivee")
        .agg(F.sum("n").alias("nb_courses"),
             settled(F.sum("miles") / F.nullif(F.sum("miles_n"), F.lit(0)), 2)
             .alias("distance_moyenne_miles"),
             settled(F.sum("amount") / F.nullif(F.sum("amount_n"), F.lit(0)), 2)
             .alias("montant_moyen_usd"))
        .orderBy(F.desc("nb_courses"), "zone_depart", "zone_arrivee")
        .limit(n))


def report_tipping(fact_trips: DataFrame, start: object, end: object) -> DataFrame:
    """Tips by service: mean, mean share of the fare (no fare, no share), share of tipped trips."""
    of_fare = F.col("tips") / F.nullif(F.col("base_fare"), F.lit(0.0))
    return (
        _between(fact_trips, start, end)
        .groupBy(F.col("service_type").alias("type_service"))
        .agg(_trips(),
             settled(F.avg("tips"), 2).alias("pourboire_moyen_usd"),
             settled(F.avg(of_fare) * 100, 1).alias("taux_pourboire_pct"),
             settled(percent(F.count_if(F.col("tips") > 0), F.count(F.lit(1))), 1)
             .alias("part_courses_avec_pourboire_pct"))
        .orderBy(F.desc("nb_courses"), "type_service"))


def report_quality(fact_trips: DataFrame, start: object, end: object) -> DataFrame:
    """Rows that cleaning should not have let through, counted in one pass."""
    return _between(fact_trips, start, end).agg(
        F.count(F.lit(1)).alias("total_lignes"),
        F.count_if(F.col("trip_miles") <= 0).alias("distance_invalide"),
        F.count_if(F.col("trip_duration_min") <= 0).alias("duree_invalide"),
        F.count_if(F.col("avg_speed_mph") > 100).alias("vitesse_aberrante"),
        F.count_if(F.col("total_amount") < 0).alias("montant_negatif"),
        F.count_if(F.col("pickup_location_id").isNull()).alias("zone_manquante"))
