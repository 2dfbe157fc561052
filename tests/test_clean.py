from __future__ import annotations

import datetime as dt

import pytest

from ridelake.operators import clean

PICKUP = dt.datetime(2024, 1, 7, 10, 5)
DROPPED_OR_KEPT = [
    ({}, True),
    ({"trip_miles": 0.0}, False),
    ({"trip_miles": -1.0}, False),
    ({"trip_miles": 0.01}, True),
    ({"trip_miles": 199.99}, True),
    ({"trip_miles": 200.0}, False),
    ({"trip_miles": None}, False),
    ({"trip_time": 59}, False),
    ({"trip_time": 60}, True),
    ({"trip_time": 18000}, True),
    ({"trip_time": 18001}, False),
    ({"trip_time": None}, False),
    ({"dropoff_datetime": PICKUP}, False),
    ({"dropoff_datetime": PICKUP - dt.timedelta(seconds=1)}, False),
    ({"dropoff_datetime": PICKUP + dt.timedelta(seconds=1)}, True),
    ({"pickup_datetime": None}, False),
    ({"dropoff_datetime": None}, False),
    ({"base_passenger_fare": -0.01}, False),
    ({"base_passenger_fare": 0.0}, True),
    ({"base_passenger_fare": None}, False),
    ({"base_passenger_fare": float("nan")}, True),
    ({"PULocationID": None, "DOLocationID": None}, True),
]


def test_every_rule_at_its_bounds(trips):
    raw = trips(*[{**change, "driver_pay": float(i)} for i, (change, _) in enumerate(DROPPED_OR_KEPT)])
    kept = {int(row.driver_pay) for row in clean.clean_trips(raw).collect()}
    assert kept == {i for i, (_, keep) in enumerate(DROPPED_OR_KEPT) if keep}


@pytest.mark.parametrize("operator, bad", [
    (clean.clean_not_null, {"pickup_datetime": None}),
    (clean.clean_time_order, {"dropoff_datetime": PICKUP}),
    (clean.clean_trip_time, {"trip_time": 59}),
    (clean.clean_trip_miles, {"trip_miles": 200.0}),
    (clean.clean_fare, {"base_passenger_fare": -0.01}),
])
def test_single_rules_keep_duplicates_and_drop_only_their_own(trips, operator, bad):
    raw = trips({}, {}, bad)
    assert operator(raw).count() == 2


def test_duplicates_compare_all_columns_and_nulls_are_equal(trips):
    raw = trips({}, {}, {"airport_fee": 2.5}, {"airport_fee": 2.5}, {"tips": None}, {"tips": None})
    assert clean.clean_dedup(raw).count() == 3
    assert clean.clean_trips(raw).count() == 3


def test_a_column_nobody_reads_still_tells_trips_apart(trips):
    raw = trips({}, {}).selectExpr("*", "monotonically_increasing_id() AS extra")
    assert clean.clean_trips(raw).count() == 2


def test_summary(trips):
    raw = trips({}, {}, {"trip_miles": 0.0}, {"base_passenger_fare": float("nan")})
    assert clean.clean_summary(raw).collect()[0].asDict() == {
        "rows_in": 4, "rows_kept": 2, "pct_rejected": 50.0, "rows_nan_fare": 1}


def test_summary_and_funnel_of_nothing(trips):
    empty = trips({}).limit(0)
    assert clean.clean_summary(empty).collect()[0].asDict() == {
        "rows_in": 0, "rows_kept": 0, "pct_rejected": 0.0, "rows_nan_fare": 0}
    assert all(row.rows_before == row.rows_after == 0 for row in clean.clean_funnel(empty).collect())


def test_funnel_counts_in_order(trips):
    raw = trips({}, {}, {"pickup_datetime": None}, {"dropoff_datetime": PICKUP, "trip_time": 1},
                {"trip_time": 1}, {"trip_miles": 0.0}, {"base_passenger_fare": -1.0},
                {"base_passenger_fare": -2.0})
    assert [tuple(row) for row in clean.clean_funnel(raw).collect()] == [
        ("dedup", 8, 7), ("not_null", 7, 6), ("time_order", 6, 5), ("trip_time", 5, 4),
        ("trip_miles", 4, 3), ("fare", 3, 1)]


def test_copies_of_one_trip_collapse_before_the_shuffle(spark, trips):
    """A third of all rows being one trip must not meet in one task."""
    raw = trips({}).crossJoin(spark.range(0, 4000, 1, 8)).drop("id")
    kept = clean.clean_trips(raw)
    assert kept.count() == 1
    text = kept._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange hashpartitioning")
    assert text.index("HashAggregate") < exchange < text.rindex("HashAggregate")
