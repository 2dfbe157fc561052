from __future__ import annotations

import math

import pytest

from ridelake_checks.compare import spark_rows
from ridelake_checks.registry import facts as facts_of
from ridelake.functions.expressions import settled
from ridelake.operators import marts
from ridelake.operators.enrich import enrich_trips, to_facts
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    return facts_of(spark, SF).cache()


def test_rollup_gives_the_same_marts(facts):
    rollup = marts.rollup_trips(facts).cache()
    direct, rolled = marts.build_marts(facts), marts.build_marts(rollup)
    assert list(direct) == list(rolled) and len(direct) == 6
    for name in direct:
        assert direct[name].columns == rolled[name].columns
        assert spark_rows(direct[name]) == spark_rows(rolled[name]), name


def test_trips_of_every_mart_add_up(facts):
    total = facts.count()
    for name, mart in marts.build_marts(facts).items():
        assert mart.agg(F.sum("nombre_trajets")).first()[0] == total, name


def test_kpi_values_by_hand(trips):
    enriched = enrich_trips(trips({}, {"tips": None, "base_passenger_fare": 10.0, "shared_match_flag": None}))
    row = enriched.agg(*marts.kpi_exprs()).first()
    assert row.asDict() == {
        "nombre_trajets": 2, "revenu_total": 40.5, "revenu_moyen": 20.25, "pourboire_moyen": 3.0,
        "taux_reversement_moyen": 1.13, "distance_moyenne": 10.0, "duree_moyenne_min": 30.0,
        "temps_attente_moyen_min": 5.0, "vitesse_moyenne_mph": 20.0, "part_partagee": 50.0,
        "part_pmr": 0.0}
    assert marts.kpi_globaux(enriched).first() == row


@pytest.mark.parametrize("roll", [False, True])
def test_no_trips(trips, roll):
    nothing = to_facts(enrich_trips(trips({}))).limit(0)
    tables = marts.build_marts(marts.rollup_trips(nothing) if roll else nothing)
    row = tables.pop("kpi_globaux").collect()
    assert len(row) == 1 and row[0].nombre_trajets == 0 and row[0].revenu_total is None
    assert all(table.count() == 0 for table in tables.values())


@pytest.mark.parametrize("roll", [False, True])
def test_null_zone_is_a_group_and_nan_reaches_the_totals(trips, roll):
    facts = to_facts(enrich_trips(trips(
        {"PULocationID": None}, {}, {}, {"base_passenger_fare": float("nan"), "hvfhs_license_num": "HV0005"})))
    source = marts.rollup_trips(facts) if roll else facts
    by_zone = {(row.zone_id, row.plateforme): row for row in marts.revenu_par_zone_depart(source).collect()}
    assert by_zone[(None, "Uber")].nombre_trajets == 1
    assert by_zone[(1, "Uber")].revenu_total == 53.5
    assert math.isnan(by_zone[(1, "Lyft")].revenu_total)
    assert math.isnan(marts.kpi_globaux(source).first().revenu_moyen)


def test_order(facts):
    counts = [row.nombre_trajets for row in marts.kpi_par_plateforme(facts).collect()]
    assert counts == sorted(counts, reverse=True)
    hours = [(row.heure, row.plateforme) for row in marts.trajets_par_heure(facts).collect()]
    assert hours == sorted(hours)
    frequency = [row.nombre_trajets for row in marts.platform_counts(facts).collect()]
    assert frequency == counts


def test_settled_rounding(spark):
    values = [1.005, 2.675, -1.005, float("nan"), float("inf"), 1e30, None, 0.1 + 0.2]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        settled(F.col("v"), 2).alias("r")).collect()
    got = [row.r for row in rows]
    assert got[:3] == [1.01, 2.68, -1.01] and math.isnan(got[3])
    assert got[4:] == [float("inf"), 1e30, None, 0.3]


def test_loaded_marts_come_from_one_stored_rollup(spark, monkeypatch):
    """The facts are rolled up once for all six marts, and no row is shuffled or sorted to write them by year."""
    from ridelake.sinks import parquet
    from ridelake_checks import loads

    write, read = parquet.write_marts, []

    def watched(tables, base):
        read.extend(path for mart in tables.values() for path in mart.inputFiles())
        return write(tables, base)

    monkeypatch.setattr(parquet, "write_marts", watched)
    rows = {row["table"]: row["rows"] for row in loads.loaded_tables(spark, "/root/testdata/sf0.001").collect()}
    assert read and all("/ridelake-rollup-" in path for path in read)
    assert len(rows) == 9 and rows["trajets_nettoyes"] == rows["fact_trips"] > 0
