"""Raw trips and zones in the shape of the data model, derived from the given tables.

The tables hold no trips; ``FIXTURES.md`` §5 maps every line item to one. The same mapping in SQL is
in ``ridelake_checks/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.session import pin_utc

DATASET = "fhvhv_tripdata"
REPORT_START, REPORT_END = "1998-01-01", "1998-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Raw column -> expression over a line item and the helpers tt, cents and pu.
TRIP = {
    "hvfhs_license_num": "'HV000' || cast(2 + l_suppkey % 5 AS string)",
    "request_datetime":
        "CASE WHEN l_orderkey % 17 <> 0 THEN timestampadd(SECOND, 60 - (l_partkey * 37) % 1000, pu) END",
    "pickup_datetime": "CASE WHEN l_orderkey % 101 <> 0 THEN pu END",
    "dropoff_datetime": "timestampadd(SECOND, CASE WHEN l_orderkey % 97 = 0 THEN -1 ELSE tt END, pu)",
    "PULocationID": "cast(l_suppkey % 26 AS bigint)",
    "DOLocationID": "cast(l_partkey % 26 AS bigint)",
    "trip_miles": "(l_quantity - 1) * 4.5D",
    "trip_time": "tt",
    "base_passenger_fare": "cast(cents AS double) / 100",
    "tolls": "CASE WHEN l_linenumber <> 1 THEN l_tax * 100 END",
    "congestion_surcharge": "CASE WHEN l_returnflag <> 'A' THEN 2.75D END",
    "airport_fee": "CASE WHEN l_returnflag = 'N' THEN 2.5D END",
    "tips": "CASE WHEN l_orderkey % 13 <> 0 THEN cast(cast(round(l_discount * 100) AS bigint) AS double) END",
    "driver_pay": "cast(floor(cast(cents AS double) * (70 + l_linenumber) / 100) AS double) / 100",
    "shared_match_flag":
        "CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END",
    "wav_request_flag":
        "CASE WHEN l_partkey % 29 = 0 THEN 'Y' WHEN l_partkey % 31 = 0 THEN NULL ELSE 'N' END",
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
}


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item, and a copy of every trip whose order number is a multiple of 50."""
    items = table(spark, sf_dir, "lineitem").withColumns({
        "tt": F.expr("(l_partkey * 7919 + l_orderkey * 31 + l_linenumber) % 20000 - 500"),
        "cents": F.expr("cast(floor(l_extendedprice) AS bigint) % 10000 - 200"),
        "pu": F.expr("timestampadd(SECOND, (l_orderkey * 7919 + l_linenumber * 3607) % 86400, l_shipdate)"),
    })
    single = items.select(*[F.expr(sql).alias(name) for name, sql in TRIP.items()])
    # Copies are made from the finished row: neither a second scan nor a second computation.
    copies = F.expr("CASE WHEN l_orderkey % 50 = 0 THEN array(0, 1) ELSE array(0) END")
    return single.withColumn("copy", F.explode(copies)).drop("copy")


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones and regions as boroughs, in the columns of the published zone lookup."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"), F.lit(None).cast("string").alias("service_zone"))


def service_type():
    return F.expr("element_at(array('fhvhv', 'yellow', 'green', 'fhv'), cast(l_linenumber % 4 AS int) + 1)")
