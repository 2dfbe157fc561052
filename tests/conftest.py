from __future__ import annotations

import datetime as dt

import pytest

from ridelake.session import build_session

RAW = ("hvfhs_license_num string, request_datetime timestamp_ntz, pickup_datetime timestamp_ntz,"
       " dropoff_datetime timestamp_ntz, PULocationID long, DOLocationID long, trip_miles double,"
       " trip_time long, base_passenger_fare double, tolls double, congestion_surcharge double,"
       " airport_fee double, tips double, driver_pay double, shared_match_flag string,"
       " wav_request_flag string")

BASE = {
    "hvfhs_license_num": "HV0003",
    "request_datetime": dt.datetime(2024, 1, 7, 10, 0),
    "pickup_datetime": dt.datetime(2024, 1, 7, 10, 5),
    "dropoff_datetime": dt.datetime(2024, 1, 7, 10, 35),
    "PULocationID": 1, "DOLocationID": 2, "trip_miles": 10.0, "trip_time": 1800,
    "base_passenger_fare": 20.0, "tolls": 1.0, "congestion_surcharge": 2.75, "airport_fee": None,
    "tips": 3.0, "driver_pay": 15.0, "shared_match_flag": "Y", "wav_request_flag": None,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session("ridelake-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(home / "warehouse"),
        "spark.checkpoint.dir": str(home / "shared"),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.files.openCostInBytes": "64k",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trips(spark):
    """Raw trips: one per dict of changes to the base row."""
    def make(*changes: dict):
        rows = [tuple({**BASE, **change}.values()) for change in changes]
        return spark.createDataFrame(rows, RAW)
    return make


@pytest.fixture(scope="session")
def zones(spark):
    return spark.createDataFrame(
        [(1, "Queens", "Astoria"), (2, "Bronx", "Fordham"), (3, None, None), (4, "Queens", None)],
        "zone_id long, arrondissement string, zone_nom string")
