from __future__ import annotations

import datetime as dt
import math

from ridelake.operators import enrich
from ridelake.operators.clean import clean_trips
from ridelake.schema import DERIVED_COLUMNS, FACT_COLUMNS


def one(trips, **change):
    return enrich.enrich_trips(trips(change)).collect()[0]


def test_the_valid_trip(trips):
    row = one(trips)
    assert {name: row[name] for name in DERIVED_COLUMNS} == {
        "plateforme": "Uber", "duree_minutes": 30.0, "temps_attente_min": 5.0, "vitesse_mph": 20.0,
        "revenu_total": 26.75, "taux_reversement": 0.75, "a_pourboire": True, "est_partagee": True,
        "est_pmr": False, "date_trajet": dt.date(2024, 1, 7), "annee": 2024, "mois": 1, "heure": 10,
        "jour_semaine": 1, "nom_jour": "Sunday", "est_weekend": True}


def test_platforms(trips):
    codes = ["HV0002", "HV0003", "HV0004", "HV0005", "HV0009", None]
    rows = enrich.enrich_platform(trips(*[{"hvfhs_license_num": code} for code in codes])).collect()
    assert [row.plateforme for row in rows] == ["Juno", "Uber", "Via", "Lyft", "Autre", "Autre"]


def test_wait_is_whole_seconds_and_never_negative(trips):
    pickup = dt.datetime(2024, 1, 7, 10, 5)
    cases = [
        (None, None),
        (pickup + dt.timedelta(seconds=1), None),
        (pickup, 0.0),
        (pickup - dt.timedelta(seconds=90), 1.5),
        (pickup - dt.timedelta(microseconds=100_000), 0.02),
    ]
    rows = enrich.enrich_wait(trips(*[{"request_datetime": request} for request, _ in cases])).collect()
    assert [row.temps_attente_min for row in rows] == [wait for _, wait in cases]


def test_revenue_treats_missing_extras_as_nothing(trips):
    row = one(trips, tips=None)
    assert (row.revenu_total, row.a_pourboire) == (23.75, False)
    assert one(trips, base_passenger_fare=None).revenu_total is None


def test_zero_fare_and_missing_pay_have_no_payout(trips):
    free = one(trips, base_passenger_fare=0.0)
    assert (free.taux_reversement, free.revenu_total) == (None, 6.75)
    assert one(trips, driver_pay=None).taux_reversement is None


def test_nan_fare_stays_nan(trips):
    row = one(trips, base_passenger_fare=float("nan"))
    assert math.isnan(row.revenu_total) and math.isnan(row.taux_reversement)


def test_rounding_is_half_up(trips):
    assert one(trips, base_passenger_fare=1.005, tolls=None, congestion_surcharge=None, tips=None
               ).revenu_total == 1.01


def test_flags(trips):
    row = one(trips, shared_match_flag=None, wav_request_flag="Y")
    assert (row.est_partagee, row.est_pmr) == (False, True)
    assert one(trips, shared_match_flag="N").est_partagee is False
    assert one(trips, tips=0.0).a_pourboire is False


def test_flags_without_values_may_be_integers(trips):
    raw = trips({}).selectExpr("* EXCEPT (wav_request_flag)", "cast(NULL AS bigint) AS wav_request_flag")
    assert enrich.enrich_flags(raw).first().est_pmr is False


def test_speed_needs_time(trips):
    rows = enrich.enrich_speed(trips({"trip_time": 0}, {"trip_time": None}, {})).collect()
    assert [row.vitesse_mph for row in rows] == [None, None, 20.0]


def test_a_week_of_calendar_columns(trips):
    days = [dt.datetime(2024, 1, 7, 23, 59) + dt.timedelta(days=n) for n in range(7)]
    rows = enrich.enrich_calendar(trips(*[{"pickup_datetime": day} for day in days])).collect()
    assert [row.jour_semaine for row in rows] == [1, 2, 3, 4, 5, 6, 7]
    assert [row.nom_jour for row in rows] == [day.strftime("%A") for day in days]
    assert [row.est_weekend for row in rows] == [True] + 5 * [False] + [True]
    assert all(row.heure == 23 for row in rows)


def test_fact_columns(trips):
    facts = enrich.to_facts(enrich.enrich_trips(clean_trips(trips({}))))
    assert facts.columns == FACT_COLUMNS and len(FACT_COLUMNS) == 22
