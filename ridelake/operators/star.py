"""Enriched trips as rows of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ridelake.schema import DERIVED_COLUMNS, MISSING_TEXT


def trip_id(enriched: DataFrame) -> Column:
    """Stable identifier: a digest of every raw value of the trip.

    Trips are distinct over all raw columns, so hashing all of them makes the id unique. Values
    are tagged with their column name and NULLs left out, hence neither the column order nor a
    column that other files added changes an id. A column that changes its type does change it: the digest is
    of the values as text.
    """
    raw = sorted((f for f in enriched.schema.fields if f.name not in DERIVED_COLUMNS),
                 key=lambda field: field.name)
    parts = []
    for field in raw:
        text = F.col(f"`{field.name}`").cast("string")
        if isinstance(field.dataType, StringType):
            text = F.replace(text, F.lit("|"), F.lit("||"))
        parts.append(F.concat(F.lit(f"{field.name}="), text))
    return F.sha2(F.concat_ws("|", *parts), 256)


def to_fact_trips(enriched: DataFrame, service_type: str | Column) -> DataFrame:
    """The fifteen declared columns plus the date that partitions the table."""
    service = F.lit(service_type) if isinstance(service_type, str) else service_type
    return enriched.select(
        trip_id(enriched).alias("trip_id"),
        F.col("pickup_datetime").cast("timestamp").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp").alias("dropoff_datetime"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        "trip_miles",
        F.col("duree_minutes").alias("trip_duration_min"),
        F.col("vitesse_mph").alias("avg_speed_mph"),
        F.col("base_passenger_fare").alias("base_fare"),
        "tips",
        "tolls",
        F.col("revenu_total").alias("total_amount"),
        service.alias("service_type"),
        F.col("heure").cast("long").alias("pickup_hour"),
        F.col("jour_semaine").cast("long").alias("pickup_dayofweek"),
        F.col("date_trajet").alias("pickup_date"),
    )


def to_dim_zones(lookup: DataFrame) -> DataFrame:
    """The published zone lookup as the zone dimension. A line without a number is no zone."""
    return lookup.where(F.col("LocationID").try_cast("long").isNotNull()).select(
        F.col("LocationID").try_cast("long").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )


def exploration_zones(dim_zones: DataFrame) -> DataFrame:
    """The zone dimension in the three-column form the exploration queries take. Placeholders such as ``N/A``
    are missing values here."""
    def text(name: str) -> Column:
        return F.when(~F.col(name).isin(MISSING_TEXT), F.col(name))
    return dim_zones.select(
        F.col("location_id").alias("zone_id"),
        text("borough").alias("arrondissement"),
        text("zone_name").alias("zone_nom"),
    )
