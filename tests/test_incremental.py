"""Facts, rollup and marts that follow the lake date by date."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest

from ridelake.operators.clean import clean_trips
from ridelake.operators.enrich import enrich_trips, to_facts
from ridelake.operators.marts import build_marts
from ridelake.plans import incremental
from ridelake.sources import landing
from ridelake_checks.compare import spark_rows


def trip(day: int, month: int = 1, **more) -> dict:
    at = dt.datetime(2024, month, day, 9)
    return {"pickup_datetime": at, "dropoff_datetime": at + dt.timedelta(minutes=30), **more}


@pytest.fixture
def place(trips, tmp_path):
    """Writes monthly files; lake and output folders."""
    def file(name: str, *rows: dict) -> None:
        os.makedirs(tmp_path / "in", exist_ok=True)
        frame = trips(*rows).toPandas()
        for column in ("request_datetime", "pickup_datetime", "dropoff_datetime"):
            frame[column] = frame[column].astype("datetime64[us]")
        frame["airport_fee"] = frame["airport_fee"].astype("float64")
        frame.to_parquet(tmp_path / "in" / f"{name}.parquet", index=False)
    return file, str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "out")


def partitions(table):
    """Date folder -> its files with their times."""
    found = {}
    for path in glob.glob(f"{table}/date_trajet=*/*.parquet"):
        found.setdefault(path.split("date_trajet=")[1][:10], set()).add((path, os.path.getmtime(path)))
    return found


def refreshed(spark, place):
    _, source, lake, out = place
    landing.land_raw(spark, source, lake)
    done = incremental.refresh(spark, lake, out)
    whole = to_facts(enrich_trips(clean_trips(landing.read_lake(spark, lake))))
    facts = spark.read.parquet(f"{out}/trajets_nettoyes")
    assert spark_rows(facts.select(*whole.columns)) == spark_rows(whole)
    for name in ("kpi_globaux", "revenu_par_zone_depart"):
        mart = build_marts(whole)[name]
        assert spark_rows(spark.read.parquet(f"{out}/{name}")) == spark_rows(mart), name
    return done


def test_replacing_a_month_rewrites_only_its_dates(spark, place):
    """January and March stay as they are; a copy across months, a date that goes and one that comes are right."""
    file, _, _, out = place
    file("t_01", trip(1), trip(2), trip(2), trip(31, tips=1.0))
    file("t_02", trip(1, 2), trip(2, 2), trip(31, tips=1.0), trip(31, tips=2.0))
    file("t_03", trip(1, 3), trip(2, 3))
    first = refreshed(spark, place)
    assert first.fresh == ["t_01.parquet", "t_02.parquet", "t_03.parquet"] and len(first.dates) == 7
    before = {name: partitions(f"{out}/{name}") for name in ("trajets_nettoyes", incremental.ROLLUP)}

    again = refreshed(spark, place)
    assert (again.fresh, again.dates, again.read) == ([], [], [])

    file("t_02", *[trip(1, 2, tips=9.0 + i) for i in range(40)], trip(3, 2), trip(31, tips=1.0))
    done = refreshed(spark, place)
    assert done.fresh == ["t_02.parquet"] and done.read == ["t_01.parquet", "t_02.parquet"]  # they share 31 January
    assert [d.isoformat() for d in done.dates] == ["2024-01-31", "2024-02-01", "2024-02-02", "2024-02-03"]
    assert [d.isoformat() for d in done.removed] == ["2024-02-02"]
    for name, old in before.items():
        new = partitions(f"{out}/{name}")
        assert {d for d in old if new.get(d) == old[d]} == {"2024-01-01", "2024-01-02", "2024-03-01", "2024-03-02"}
        assert "2024-02-02" not in new and "2024-02-03" in new


def test_a_month_without_trips_and_dates_without_clean_trips(spark, place):
    file, _, _, out = place
    file("t_01", trip(1), trip(2))
    file("t_02")
    assert refreshed(spark, place).fresh == ["t_01.parquet", "t_02.parquet"]
    file("t_01", *[trip(1, trip_miles=0.0, tips=i / 3) for i in range(40)], trip(2, trip_time=700))
    done = refreshed(spark, place)
    assert [d.day for d in done.dates] == [1, 2] and [d.day for d in done.removed] == [1]


def test_old_dates_are_not_read(spark, place):
    """Partitions of other dates, and lake files without trips of the touched ones, may be unreadable."""
    file, source, lake, out = place
    file("t_01", trip(1), trip(2))
    file("t_02", trip(1, 2))
    refreshed(spark, place)
    for path in [*glob.glob(f"{out}/trajets_nettoyes/date_trajet=2024-01-*/*.parquet"),
                 *glob.glob(f"{lake}/version=*/source_file=t_01.parquet/*.parquet")]:
        size = os.path.getsize(path)
        with open(path, "wb") as broken:
            broken.write(b"x" * size)
    file("t_02", *[trip(1, 2, tips=i / 3) for i in range(40)], trip(9, 2))
    landing.land_raw(spark, source, lake)
    done = incremental.refresh(spark, lake, out)
    assert done.read == ["t_02.parquet"] and len(done.dates) == 2
    total = spark.read.parquet(f"{out}/kpi_globaux").first().nombre_trajets
    assert total == 2 + 41


def test_an_interrupted_refresh_is_done_again(spark, place, monkeypatch):
    """Facts are replaced, the index is not."""
    file, source, lake, out = place
    file("t_01", trip(1), trip(2))
    refreshed(spark, place)
    file("t_01", *[trip(1, tips=7.0 + i) for i in range(40)])
    landing.land_raw(spark, source, lake)

    def broken(*_):
        raise RuntimeError("interrupted")
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "try_commit", broken)
        with pytest.raises(RuntimeError):
            incremental.refresh(spark, lake, out)
    done = refreshed(spark, place)
    assert [d.day for d in done.dates] == [1, 2]
