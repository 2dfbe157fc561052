from __future__ import annotations

import datetime as dt

import pytest

from ridelake.operators import filters
from ridelake.operators.enrich import enrich_trips, to_facts
from ridelake.plans import explore


@pytest.fixture(scope="module")
def facts(trips):
    at = lambda day, hour: {"pickup_datetime": dt.datetime(2024, 1, day, hour)}
    return to_facts(enrich_trips(trips(
        {}, {**at(8, 0), "shared_match_flag": None}, {**at(9, 23), "hvfhs_license_num": "HV0005", "PULocationID": 2},
        {**at(13, 12), "wav_request_flag": "Y", "PULocationID": 3},
        {**at(14, 12), "hvfhs_license_num": None, "PULocationID": None}, {**at(15, 12), "PULocationID": 77})))


def days(df):
    return sorted(row.date_trajet.day for row in df.collect())


def test_filters(facts, zones):
    assert days(filters.filter_platform(facts, ["Uber"])) == [7, 8, 13, 15]
    assert days(filters.filter_platform(facts, [])) == []
    assert days(filters.filter_dates(facts, "2024-01-08", "2024-01-13")) == [8, 9, 13]
    assert days(filters.filter_dates(facts, dt.date(2024, 1, 8), None)) == [7, 8, 9, 13, 14, 15]
    assert days(filters.filter_hours(facts, 0, 12)) == [7, 8, 13, 14, 15]
    assert days(filters.filter_daytype(facts, "weekend")) == [7, 13, 14]
    assert days(filters.filter_daytype(facts, "week")) == [8, 9, 15]
    assert days(filters.filter_daytype(facts, "all")) == [7, 8, 9, 13, 14, 15]
    with pytest.raises(ValueError):
        filters.filter_daytype(facts, "lundi")
    assert days(filters.filter_shared(facts, True)) == [7, 9, 13, 14, 15]
    assert days(filters.filter_shared(facts, False)) == [7, 8, 9, 13, 14, 15]
    assert days(filters.filter_wav(facts, True)) == [13]
    assert days(filters.filter_borough(facts, zones, ["Queens"])) == [7, 8]
    assert days(filters.filter_borough(facts, zones, ["Queens", "Bronx"])) == [7, 8, 9]
    assert days(filters.filter_borough(facts, zones, [])) == [7, 8, 9, 13, 14, 15]
    assert days(filters.filter_borough(facts, None, ["Queens"])) == [7, 8, 9, 13, 14, 15]


def test_combined(facts, zones):
    assert days(filters.apply_filters(facts, zones, filters.Filters())) == [7, 8, 9, 13, 14, 15]
    chosen = filters.Filters(platforms=["Uber"], start="2024-01-01", end="2024-01-31", first_hour=1,
                             day_type="weekend", shared_only=True, boroughs=["Queens"])
    assert days(filters.apply_filters(facts, zones, chosen)) == [7]
    assert explore.is_empty(filters.apply_filters(facts, zones, filters.Filters(platforms=[])))
    assert not explore.is_empty(facts)


def test_semi_join_does_not_multiply(facts, zones):
    doubled = zones.union(zones)
    assert days(filters.filter_borough(facts, doubled, ["Queens"])) == [7, 8]


def test_french_days(facts):
    names = {row.date_trajet.day: row.nom_jour_fr for row in explore.facts_with_day_fr(facts).collect()}
    assert names == {7: "Dimanche", 8: "Lundi", 9: "Mardi", 13: "Samedi", 14: "Dimanche", 15: "Lundi"}
    unknown = facts.limit(1).withColumn("jour_semaine", facts["heure"] * 0 + 8)
    assert explore.facts_with_day_fr(unknown).first().nom_jour_fr is None
    assert explore.explore_by_weekday(unknown).count() == 0


def test_zone_labels_fall_back(facts, zones):
    labels = {row.zone_id: row.libelle for row in explore.explore_zone_labels(facts, zones).collect()}
    assert labels == {1: "Astoria (Queens)", 2: "Fordham (Bronx)", 3: "Zone 3 (?)", 77: "Zone 77 (?)"}
    bare = {row.zone_id: row.libelle for row in explore.explore_zone_labels(facts, None).collect()}
    assert bare == {1: "Zone 1", 2: "Zone 2", 3: "Zone 3", 77: "Zone 77"}
    top = explore.explore_top15(facts, zones).collect()
    assert (top[0].zone_id, top[0].nombre_trajets) == (1, 2)
    assert [row.zone_id for row in top] == [1, 2, 3, 77]
    assert explore.explore_zone_table(facts, None).first().zone_id == 1


def test_shares_and_band(facts):
    share = explore.explore_platform_share(facts).collect()
    assert [(row.plateforme, row.nombre_trajets, row.part_pct) for row in share] == [
        ("Uber", 4, 66.666667), ("Autre", 1, 16.666667), ("Lyft", 1, 16.666667)]
    band = explore.explore_kpis(facts).first()
    assert (band.nombre_trajets, band.part_partagee, band.part_pmr) == (6, 83.333333, 16.666667)
    nothing = explore.explore_kpis(facts.limit(0)).first()
    assert (nothing.nombre_trajets, nothing.revenu_total) == (0, None)


def test_months_preview_and_domains(facts, zones):
    assert {row.annee_mois for row in explore.explore_by_month(facts).collect()} == {"2024-01"}
    assert [row.date_trajet.day for row in explore.explore_preview(facts).collect()] == [7, 8, 9, 13, 14, 15]
    assert explore.explore_preview(facts, ordered=False).count() == 6
    assert explore.explore_row_count(facts).first().nombre_trajets == 6
    found = [tuple(row) for row in explore.explore_domains(facts, zones).collect()]
    assert found == [
        ("arrondissement", "Bronx"), ("arrondissement", "Queens"), ("date", "2024-01-07"),
        ("date", "2024-01-15"), ("plateforme", "Autre"), ("plateforme", "Lyft"), ("plateforme", "Uber")]
    assert [row.domaine for row in explore.explore_domains(facts.limit(0), None).collect()] == []


def test_nan_counts_for_nothing(spark, trips):
    rows = to_facts(enrich_trips(trips({}, {"base_passenger_fare": float("nan")})))
    one = to_facts(enrich_trips(trips({})))
    got, want = explore.explore_kpis(rows).first(), explore.explore_kpis(one).first()
    assert got.nombre_trajets == 2 and got.revenu_total == want.revenu_total and got.revenu_moyen == want.revenu_moyen
    assert explore.explore_by_month(rows).first().revenu_total == explore.explore_by_month(one).first().revenu_total
    assert explore.explore_by_zone(rows).first().revenu_moyen == explore.explore_by_zone(one).first().revenu_moyen
