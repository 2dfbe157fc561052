from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.operators import quality, star
from ridelake.operators.clean import clean_trips
from ridelake.operators.enrich import enrich_trips
from ridelake.plans import reports
from ridelake.session import settings
from ridelake.sinks import warehouse

DAY = ("2024-01-07", "2024-01-07")


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame(
        [(1, "Queens", "Astoria", "x"), (2, "Bronx", "Fordham", "x"), (4, "Queens", "Astoria", "y")],
        "location_id long, borough string, zone_name string, service_zone string")


def star_of(raw, service="fhvhv"):
    return star.to_fact_trips(enrich_trips(clean_trips(raw)), service)


def test_columns_and_types(trips):
    table = star_of(trips({}))
    assert table.columns == list(warehouse.FACT_TRIPS_COLUMNS)
    assert dict(table.dtypes)["pickup_datetime"] == "timestamp"
    assert dict(table.dtypes)["pickup_hour"] == "bigint"
    row = table.first()
    assert (row.service_type, row.total_amount, row.pickup_dayofweek) == ("fhvhv", 26.75, 1)


def test_trip_id_is_unique_and_stable(trips):
    raw = trips({}, {"tips": None}, {"tips": 0.0}, {"DOLocationID": None}, {"PULocationID": None},
                {"hvfhs_license_num": "a|b"}, {"hvfhs_license_num": "a||b"})
    ids = {row.trip_id for row in star_of(raw).select("trip_id").collect()}
    assert len(ids) == 7
    wider = raw.select(*reversed(raw.columns)).withColumn("later_column", F.lit(None).cast("double"))
    assert {row.trip_id for row in star_of(wider).select("trip_id").collect()} == ids


def test_reports_join_names_after_aggregating(trips, dims):
    table = star_of(trips({}, {"tips": 1.0}, {"PULocationID": 4}, {"PULocationID": 9}, {"PULocationID": None},
                          {"DOLocationID": 1, "base_passenger_fare": 0.0}))
    top = [tuple(row) for row in reports.report_top_zones(table, dims, *DAY).collect()]
    assert top == [("Queens", "Astoria", 4, 85.0)]
    pairs = [tuple(row) for row in reports.report_top_od(table, dims, *DAY).collect()]
    assert pairs == [("Astoria", "Fordham", 3, 10.0, 26.08), ("Astoria", "Astoria", 1, 10.0, 6.75)]
    assert reports.report_daily(table, "2024-01-08", "2024-01-31").count() == 0


def test_tipping_without_fare_and_quality(trips):
    table = star_of(trips({}, {"base_passenger_fare": 0.0, "tips": None}, {"trip_miles": 150.0}))
    row = reports.report_tipping(table, *DAY).first()
    assert tuple(row) == ("fhvhv", 3, 3.0, 15.0, 66.7)
    assert tuple(reports.report_quality(table, *DAY).first()) == (3, 0, 0, 1, 0, 0)
    assert tuple(reports.report_quality(table, "2020-01-01", "2020-01-02").first()) == (0, 0, 0, 0, 0, 0)


def test_not_null(trips):
    raw = trips({}, {"pickup_datetime": None}, {"pickup_datetime": None, "tips": None})
    found = {row.column: row.violations for row in quality.check_not_null(raw, ["pickup_datetime", "tips", "tolls"]).collect()}
    assert found == {"pickup_datetime": 2, "tips": 1, "tolls": 0}
    with pytest.raises(quality.ConstraintViolation, match="pickup_datetime: 2"):
        quality.assert_not_null(raw, ["pickup_datetime", "tolls"])
    assert quality.assert_not_null(raw, ["tolls"]) is raw


def test_tables_guard_and_pruning(spark, trips, dims):
    table = star_of(trips({}, {"tips": 9.0}))
    assert warehouse.load_fact_trips(table, "star_db") == 2
    assert warehouse.load_fact_trips(table, "star_db") == 2
    assert warehouse.load_dim_zones(dims, "star_db") == 3
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        later = {"pickup_datetime": dt.datetime(2024, 1, 8), "dropoff_datetime": dt.datetime(2024, 1, 9)}
        assert warehouse.load_fact_trips(star_of(trips(later)), "star_db") == 1
        assert warehouse.load_fact_trips(table, "star_db") == 2
    stored = spark.table("star_db.fact_trips")
    assert stored.columns == list(warehouse.FACT_TRIPS_COLUMNS)

    with pytest.raises(quality.MissingPartitionFilter, match="pickup_date"):
        quality.require_partition_filter(stored.where("trip_miles > 1"))
    quality.require_partition_filter(spark.table("star_db.dim_zones"))
    for report in (reports.report_daily, reports.report_heatmap, reports.report_tipping, reports.report_quality):
        assert quality.require_partition_filter(report(stored, *DAY)).count() == 1
    for report in (reports.report_top_zones, reports.report_top_od):
        asked = quality.require_partition_filter(report(stored, spark.table("star_db.dim_zones"), *DAY))
        assert asked.count() == 1


def test_load_refuses_null_in_required_columns(trips, dims):
    broken = star_of(trips({})).withColumn("pickup_datetime", F.lit(None).cast("timestamp"))
    with pytest.raises(Exception, match="NULL in required column pickup_datetime"):
        warehouse.load_fact_trips(broken, "star_db2")
    with pytest.raises(Exception, match="NULL in required column location_id"):
        warehouse.load_dim_zones(dims.withColumn("location_id", F.lit(None).cast("long")), "star_db2")
