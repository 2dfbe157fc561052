"""The same queries in SQL for DuckDB, over the given tables.

Written independently of the Spark plans: each statement spells out the whole computation from the
line items. Rounded aggregates are cut to ten decimals first, as in ``settled``. Rounded row values
are rounded half-up on their shortest decimal form, which is how Spark rounds a double; DuckDB's own
``round`` scales the double first and falls below some ties.
"""

from __future__ import annotations

TRIPS = """
items AS (
  SELECT *,
    (l_partkey * 7919 + l_orderkey * 31 + l_linenumber) % 20000 - 500 AS tt,
    CAST(floor(l_extendedprice) AS BIGINT) % 10000 - 200 AS cents,
    l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 3607) % 86400) AS pu
  FROM lineitem),
single AS (
  SELECT
    'HV000' || CAST(2 + l_suppkey % 5 AS VARCHAR) AS hvfhs_license_num,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE pu + to_seconds(60 - (l_partkey * 37) % 1000) END AS request_datetime,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE pu END AS pickup_datetime,
    CASE WHEN l_orderkey % 97 = 0 THEN pu - to_seconds(1) ELSE pu + to_seconds(tt) END AS dropoff_datetime,
    CAST(l_suppkey % 26 AS BIGINT) AS "PULocationID",
    CAST(l_partkey % 26 AS BIGINT) AS "DOLocationID",
    (l_quantity - 1) * 4.5 AS trip_miles,
    tt AS trip_time,
    CAST(cents AS DOUBLE) / 100 AS base_passenger_fare,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax * 100 END AS tolls,
    CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(2.75 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN l_returnflag = 'N' THEN CAST(2.5 AS DOUBLE) END AS airport_fee,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS DOUBLE) END AS tips,
    floor(CAST(cents AS DOUBLE) * (70 + l_linenumber) / 100) / 100 AS driver_pay,
    CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS shared_match_flag,
    CASE WHEN l_partkey % 29 = 0 THEN 'Y' WHEN l_partkey % 31 = 0 THEN NULL ELSE 'N' END AS wav_request_flag,
    l_orderkey, l_linenumber
  FROM items),
raw AS (SELECT * FROM single UNION ALL SELECT * FROM single WHERE l_orderkey % 50 = 0)"""

KEEP = """pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND dropoff_datetime > pickup_datetime AND trip_time >= 60 AND trip_time <= 18000
    AND trip_miles > 0 AND trip_miles < 200 AND base_passenger_fare >= 0"""

CLEAN = f"{TRIPS},\nclean AS (SELECT DISTINCT * FROM raw WHERE {KEEP})"


def _half_up(value: str) -> str:
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


# Derived column -> SQL over a clean trip.
DERIVED = {
    "plateforme": """CASE hvfhs_license_num WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber'
      WHEN 'HV0004' THEN 'Via' WHEN 'HV0005' THEN 'Lyft' ELSE 'Autre' END""",
    "duree_minutes": _half_up("trip_time / 60"),
    "temps_attente_min": f"""CASE WHEN request_datetime <= pickup_datetime
      THEN {_half_up("date_diff('second', request_datetime, pickup_datetime) / 60")} END""",
    "vitesse_mph": _half_up("trip_miles / (trip_time / 3600)"),
    "revenu_total": _half_up("""base_passenger_fare + coalesce(tolls, 0) + coalesce(congestion_surcharge, 0)
      + coalesce(airport_fee, 0) + coalesce(tips, 0)"""),
    "taux_reversement": f"""CASE WHEN base_passenger_fare <> 0
      THEN {_half_up("driver_pay / base_passenger_fare")} END""",
    "a_pourboire": "coalesce(tips, 0) > 0",
    "est_partagee": "coalesce(shared_match_flag = 'Y', false)",
    "est_pmr": "coalesce(wav_request_flag = 'Y', false)",
    "date_trajet": "CAST(pickup_datetime AS DATE)",
    "annee": "CAST(year(pickup_datetime) AS INTEGER)",
    "mois": "CAST(month(pickup_datetime) AS INTEGER)",
    "heure": "CAST(hour(pickup_datetime) AS INTEGER)",
    "jour_semaine": "CAST(dayofweek(pickup_datetime) + 1 AS INTEGER)",
    "nom_jour": "dayname(pickup_datetime)",
    "est_weekend": "dayofweek(pickup_datetime) IN (0, 6)",
}


def _derived(*names: str) -> str:
    return ",\n    ".join(f"{DERIVED[name]} AS {name}" for name in names)


ENRICHED = f"{CLEAN},\nenriched AS (SELECT *,\n    {_derived(*DERIVED)}\n  FROM clean)"

FACT_COLUMNS = """plateforme, "PULocationID", "DOLocationID", trip_miles, duree_minutes,
    temps_attente_min, vitesse_mph, base_passenger_fare, revenu_total, tips, driver_pay,
    taux_reversement, a_pourboire, est_partagee, est_pmr, date_trajet, annee, mois, heure,
    jour_semaine, nom_jour, est_weekend"""
FACTS = f"{ENRICHED},\nfacts AS (SELECT {FACT_COLUMNS} FROM enriched)"

ZONES = """
dim_zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone_name,
    CAST(NULL AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey),
zones AS (SELECT location_id AS zone_id, borough AS arrondissement, zone_name AS zone_nom FROM dim_zones)"""


def _tagged(name: str, text: bool = False) -> str:
    value = f"replace({name}, '|', '||')" if text else f"CAST({name} AS VARCHAR)"
    return "'" + name.strip('"') + "=' || " + value


# Raw columns in the byte order of their names.
TRIP_ID = "sha256(concat_ws('|', " + ", ".join([
    _tagged('"DOLocationID"'), _tagged('"PULocationID"'), _tagged("airport_fee"),
    _tagged("base_passenger_fare"), _tagged("congestion_surcharge"), _tagged("driver_pay"),
    _tagged("dropoff_datetime"), _tagged("hvfhs_license_num", True), _tagged("l_linenumber"),
    _tagged("l_orderkey"), _tagged("pickup_datetime"), _tagged("request_datetime"),
    _tagged("shared_match_flag", True), _tagged("tips"), _tagged("tolls"), _tagged("trip_miles"),
    _tagged("trip_time"), _tagged("wav_request_flag", True)]) + "))"

STAR = f"""{ENRICHED},
fact_trips AS (
  SELECT {TRIP_ID} AS trip_id,
    pickup_datetime, dropoff_datetime,
    "PULocationID" AS pickup_location_id, "DOLocationID" AS dropoff_location_id, trip_miles,
    duree_minutes AS trip_duration_min, vitesse_mph AS avg_speed_mph,
    base_passenger_fare AS base_fare, tips, tolls, revenu_total AS total_amount,
    CASE l_linenumber % 4 WHEN 0 THEN 'fhvhv' WHEN 1 THEN 'yellow' WHEN 2 THEN 'green' ELSE 'fhv' END AS service_type,
    CAST(heure AS BIGINT) AS pickup_hour, CAST(jour_semaine AS BIGINT) AS pickup_dayofweek,
    date_trajet AS pickup_date
  FROM enriched),
period AS (SELECT * FROM fact_trips WHERE pickup_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31')"""


def _rounded(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def _mean(column: str, digits: int = 2) -> str:
    return _rounded(f"avg({column})", digits)


def _total(column: str, digits: int = 2) -> str:
    return _rounded(f"sum({column})", digits)


def _share(flag: str, digits: int = 2) -> str:
    return _rounded(f"100 * avg(CASE WHEN {flag} THEN 1 ELSE 0 END)", digits)


KPI = f"""count(*) AS nombre_trajets,
    {_total('revenu_total')} AS revenu_total,
    {_mean('revenu_total')} AS revenu_moyen,
    {_mean('tips')} AS pourboire_moyen,
    {_mean('taux_reversement')} AS taux_reversement_moyen,
    {_mean('trip_miles')} AS distance_moyenne,
    {_mean('duree_minutes')} AS duree_moyenne_min,
    {_mean('temps_attente_min')} AS temps_attente_moyen_min,
    {_mean('vitesse_mph')} AS vitesse_moyenne_mph,
    {_share('est_partagee')} AS part_partagee,
    {_share('est_pmr')} AS part_pmr"""

MARTS = {
    "kpi_globaux": f"SELECT {KPI} FROM enriched",
    "kpi_par_plateforme": f"SELECT plateforme, {KPI} FROM enriched GROUP BY plateforme",
    "trajets_par_heure": f"""SELECT heure, plateforme, count(*) AS nombre_trajets,
    {_mean('revenu_total')} AS revenu_moyen, {_mean('duree_minutes')} AS duree_moyenne_min,
    {_mean('temps_attente_min')} AS temps_attente_moyen_min
  FROM enriched GROUP BY heure, plateforme""",
    "trajets_par_jour_semaine": f"""SELECT jour_semaine, nom_jour, est_weekend, plateforme,
    count(*) AS nombre_trajets, {_mean('revenu_total')} AS revenu_moyen
  FROM enriched GROUP BY jour_semaine, nom_jour, est_weekend, plateforme""",
    "trajets_par_annee_mois": f"""SELECT annee, mois, plateforme, count(*) AS nombre_trajets,
    {_total('revenu_total')} AS revenu_total, {_mean('revenu_total')} AS revenu_moyen,
    {_mean('trip_miles')} AS distance_moyenne
  FROM enriched GROUP BY annee, mois, plateforme""",
    "revenu_par_zone_depart": f"""SELECT "PULocationID" AS zone_id, plateforme, count(*) AS nombre_trajets,
    {_total('revenu_total')} AS revenu_total, {_mean('revenu_total')} AS revenu_moyen,
    {_mean('trip_miles')} AS distance_moyenne
  FROM enriched GROUP BY "PULocationID", plateforme""",
}

ZONE_ROWS = f"""
by_zone AS (
  SELECT "PULocationID" AS zone_id, count(*) AS nombre_trajets,
    {_total('revenu_total')} AS revenu_total, {_mean('revenu_total')} AS revenu_moyen
  FROM facts WHERE "PULocationID" IS NOT NULL GROUP BY "PULocationID"),
labelled AS (
  SELECT b.*, arrondissement, zone_nom,
    coalesce(zone_nom, 'Zone ' || CAST(zone_id AS VARCHAR)) || ' (' || coalesce(arrondissement, '?') || ')' AS libelle
  FROM by_zone b LEFT JOIN zones USING (zone_id))"""

DAY_FR = """CASE jour_semaine WHEN 1 THEN 'Dimanche' WHEN 2 THEN 'Lundi' WHEN 3 THEN 'Mardi'
    WHEN 4 THEN 'Mercredi' WHEN 5 THEN 'Jeudi' WHEN 6 THEN 'Vendredi' WHEN 7 THEN 'Samedi' END"""

MONTHS = """
names AS (
  SELECT 'fhvhv_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS name, *
  FROM raw WHERE pickup_datetime IS NOT NULL)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _rule(predicate: str) -> str:
    return _with(TRIPS, f"SELECT * FROM raw WHERE {predicate}")


def _enrich(*names: str) -> str:
    return _with(CLEAN, f"SELECT *, {_derived(*names)} FROM clean")


def _facts(body: str) -> str:
    return _with(FACTS, body)


def _zones(body: str) -> str:
    return _with(f"{FACTS},{ZONES}", body)


def _labels(body: str) -> str:
    return _with(f"{FACTS},{ZONES},{ZONE_ROWS}", body)


def _star(body: str) -> str:
    return _with(STAR, body)


def _star_zones(body: str) -> str:
    return _with(f"{STAR},{ZONES}", body)


FUNNEL = """
d AS (SELECT DISTINCT * FROM raw),
c AS (SELECT
    (SELECT count(*) FROM raw) AS n0,
    count(*) AS n1,
    count(*) FILTER (WHERE ok2) AS n2,
    count(*) FILTER (WHERE ok2 AND ok3) AS n3,
    count(*) FILTER (WHERE ok2 AND ok3 AND ok4) AS n4,
    count(*) FILTER (WHERE ok2 AND ok3 AND ok4 AND ok5) AS n5,
    count(*) FILTER (WHERE ok2 AND ok3 AND ok4 AND ok5 AND ok6) AS n6
  FROM (SELECT
      pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AS ok2,
      dropoff_datetime > pickup_datetime AS ok3,
      trip_time BETWEEN 60 AND 18000 AS ok4,
      trip_miles > 0 AND trip_miles < 200 AS ok5,
      base_passenger_fare >= 0 AS ok6
    FROM d))
SELECT 'dedup' AS rule, n0 AS rows_before, n1 AS rows_after FROM c
UNION ALL SELECT 'not_null', n1, n2 FROM c
UNION ALL SELECT 'time_order', n2, n3 FROM c
UNION ALL SELECT 'trip_time', n3, n4 FROM c
UNION ALL SELECT 'trip_miles', n4, n5 FROM c
UNION ALL SELECT 'fare', n5, n6 FROM c"""

ORACLE: dict[str, str] = {
    "raw_unified": """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
  CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS BIGINT) AS o_custkey,
  CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice,
  CAST(NULL AS TIMESTAMP) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM lineitem
UNION ALL BY NAME
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "widen_ints": "SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem",
    "union_tolerant": _with(TRIPS, """
SELECT * REPLACE (CASE WHEN l_linenumber <= 3 THEN airport_fee END AS airport_fee) FROM raw"""),
    "expected_periods": _with(f"{TRIPS},{MONTHS}", """
SELECT name, name NOT IN (SELECT name FROM names) AS missing
FROM (SELECT 'fhvhv_tripdata_' || CAST(y AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '.parquet' AS name
  FROM range(1992, 2003) AS years(y), range(1, 13) AS months(m))"""),
    "head_per_file": """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
  CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS BIGINT) AS o_custkey,
  CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice,
  CAST(NULL AS TIMESTAMP) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority,
  'lineitem.parquet' AS source_file
FROM (SELECT * FROM lineitem LIMIT 10)
UNION ALL BY NAME
SELECT *, 'orders.parquet' AS source_file FROM (SELECT * FROM orders LIMIT 10)""",
    "dim_zones": _with(ZONES, "SELECT * FROM zones"),
    "facts_with_day_fr": _facts(f"SELECT *, {DAY_FR} AS nom_jour_fr FROM facts"),
    "facts_roundtrip": _facts("SELECT * FROM facts"),
    "warehouse_row_counts": _with(
        f"{ENRICHED},\n" + ",\n".join(f"{name} AS ({sql})" for name, sql in MARTS.items()),
        "SELECT 'trajets_nettoyes' AS \"table\", count(*) AS \"rows\" FROM enriched"
        + "".join(f"\nUNION ALL SELECT '{name}', count(*) FROM {name}" for name in MARTS)),
    "landing_actions": _with(f"{TRIPS},{MONTHS}", """,
source AS (SELECT name, count(*) AS length FROM names GROUP BY name),
lake AS (SELECT name, count(*) AS landed FROM names
  WHERE pickup_datetime < TIMESTAMP '1999-01-01' AND (trip_miles > 0 OR month(pickup_datetime) > 6)
  GROUP BY name)
SELECT name, length, CASE WHEN landed IS NULL THEN 'new' WHEN landed = length THEN 'skip' ELSE 'replace' END AS action
FROM source LEFT JOIN lake USING (name)""".lstrip("\n")),
    "dim_zones_table": _with(ZONES, "SELECT * FROM dim_zones"),
    "not_null_check": _with(TRIPS, "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) - count({name}) AS violations FROM raw"
        for name in ("request_datetime", "pickup_datetime", "dropoff_datetime", "tips"))),
    "fact_trips": _star("SELECT * FROM fact_trips"),
    "clean_dedup": _with(TRIPS, "SELECT DISTINCT * FROM raw"),
    "clean_not_null": _rule("pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL"),
    "clean_time_order": _rule("dropoff_datetime > pickup_datetime"),
    "clean_trip_time": _rule("trip_time >= 60 AND trip_time <= 18000"),
    "clean_trip_miles": _rule("trip_miles > 0 AND trip_miles < 200"),
    "clean_fare": _rule("base_passenger_fare >= 0"),
    "clean_trips": _with(CLEAN, "SELECT * FROM clean"),
    "clean_summary": _with(CLEAN, f"""
SELECT rows_in, rows_kept, {_rounded('100 * (rows_in - rows_kept) / CAST(rows_in AS DOUBLE)', 1)} AS pct_rejected,
  rows_nan_fare
FROM (SELECT (SELECT count(*) FROM raw) AS rows_in, count(*) AS rows_kept,
    count(*) FILTER (WHERE isnan(base_passenger_fare)) AS rows_nan_fare FROM clean)"""),
    "clean_funnel": _with(f"{TRIPS},{FUNNEL}", ""),
    "enrich_platform": _enrich("plateforme"),
    "enrich_duration": _enrich("duree_minutes"),
    "enrich_wait": _enrich("temps_attente_min"),
    "enrich_speed": _enrich("vitesse_mph"),
    "enrich_revenue": _enrich("revenu_total"),
    "enrich_payout": _enrich("taux_reversement"),
    "enrich_flags": _enrich("a_pourboire", "est_partagee", "est_pmr"),
    "enrich_calendar": _enrich(
        "date_trajet", "annee", "mois", "heure", "jour_semaine", "nom_jour", "est_weekend"),
    "facts": _facts("SELECT * FROM facts"),
    **{name: _with(ENRICHED, sql) for name, sql in MARTS.items()},
    "platform_counts": _with(
        ENRICHED, "SELECT plateforme, count(*) AS nombre_trajets FROM enriched GROUP BY plateforme"),
    "report_daily": _star(f"""
SELECT pickup_date AS jour, count(*) AS nb_courses, {_mean('trip_miles')} AS distance_moyenne_miles,
  {_mean('total_amount')} AS montant_moyen_usd
FROM period GROUP BY pickup_date"""),
    "report_heatmap": _star(f"""
SELECT pickup_dayofweek AS jour_semaine, pickup_hour AS heure, count(*) AS nb_courses,
  {_mean('trip_duration_min', 1)} AS duree_moyenne_min
FROM period GROUP BY pickup_dayofweek, pickup_hour"""),
    "report_top_zones": _star_zones(f"""
SELECT borough AS arrondissement, zone_name AS zone, count(*) AS nb_courses,
  {_total('total_amount')} AS revenu_total_usd
FROM period JOIN dim_zones ON pickup_location_id = location_id
GROUP BY borough, zone_name ORDER BY nb_courses DESC, zone, arrondissement LIMIT 20"""),
    "report_top_od": _star_zones(f"""
SELECT o.zone_name AS zone_depart, d.zone_name AS zone_arrivee, count(*) AS nb_courses,
  {_mean('trip_miles')} AS distance_moyenne_miles, {_mean('total_amount')} AS montant_moyen_usd
FROM period
JOIN dim_zones o ON pickup_location_id = o.location_id
JOIN dim_zones d ON dropoff_location_id = d.location_id
GROUP BY o.zone_name, d.zone_name ORDER BY nb_courses DESC, zone_depart, zone_arrivee LIMIT 20"""),
    "report_tipping": _star(f"""
SELECT service_type AS type_service, count(*) AS nb_courses, {_mean('tips')} AS pourboire_moyen_usd,
  {_rounded('avg(tips / nullif(base_fare, 0)) * 100', 1)} AS taux_pourboire_pct,
  {_rounded('count(*) FILTER (WHERE tips > 0) * CAST(100 AS DOUBLE) / count(*)', 1)} AS part_courses_avec_pourboire_pct
FROM period GROUP BY service_type"""),
    "report_quality": _star("""
SELECT count(*) AS total_lignes,
  count(*) FILTER (WHERE trip_miles <= 0) AS distance_invalide,
  count(*) FILTER (WHERE trip_duration_min <= 0) AS duree_invalide,
  count(*) FILTER (WHERE avg_speed_mph > 100) AS vitesse_aberrante,
  count(*) FILTER (WHERE total_amount < 0) AS montant_negatif,
  count(*) FILTER (WHERE pickup_location_id IS NULL) AS zone_manquante
FROM period"""),
    "filter_platform": _facts("SELECT * FROM facts WHERE plateforme IN ('Uber', 'Juno')"),
    "filter_dates": _facts(
        "SELECT * FROM facts WHERE date_trajet >= DATE '1997-02-01' AND date_trajet <= DATE '1998-01-31'"),
    "filter_hours": _facts("SELECT * FROM facts WHERE heure >= 7 AND heure <= 9"),
    "filter_daytype": _facts("SELECT * FROM facts WHERE est_weekend"),
    "filter_shared": _facts("SELECT * FROM facts WHERE est_partagee"),
    "filter_wav": _facts("SELECT * FROM facts WHERE est_pmr"),
    "filter_borough": _zones("""
SELECT * FROM facts WHERE "PULocationID" IN (SELECT zone_id FROM zones WHERE arrondissement = 'EUROPE')"""),
    "filter_combined": _zones("""
SELECT * FROM facts
WHERE plateforme IN ('Uber', 'Lyft', 'Autre')
  AND date_trajet >= DATE '1996-03-01' AND date_trajet <= DATE '1999-06-30'
  AND heure >= 6 AND heure <= 20 AND NOT est_weekend AND est_partagee
  AND "PULocationID" IN (SELECT zone_id FROM zones WHERE arrondissement IN ('EUROPE', 'ASIA'))"""),
    "explore_kpis": _facts(f"""
SELECT count(*) AS nombre_trajets, {_total('revenu_total', 6)} AS revenu_total,
  {_mean('revenu_total', 6)} AS revenu_moyen, {_mean('tips', 6)} AS pourboire_moyen,
  {_mean('taux_reversement', 6)} AS taux_reversement_moyen,
  {_mean('trip_miles', 6)} AS distance_moyenne, {_mean('duree_minutes', 6)} AS duree_moyenne_min,
  {_mean('temps_attente_min', 6)} AS temps_attente_moyen_min,
  {_share('est_partagee', 6)} AS part_partagee, {_share('est_pmr', 6)} AS part_pmr
FROM facts"""),
    "explore_platform_share": _facts(f"""
SELECT plateforme, count(*) AS nombre_trajets,
  {_rounded('count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM facts)', 6)} AS part_pct,
  {_mean('revenu_total', 6)} AS revenu_moyen
FROM facts GROUP BY plateforme"""),
    "explore_platform_means": _facts(f"""
SELECT plateforme, count(*) AS nombre_trajets, {_mean('revenu_total')} AS revenu_moyen,
  {_mean('tips')} AS pourboire_moyen, {_mean('vitesse_mph')} AS vitesse_moyenne_mph,
  {_mean('temps_attente_min')} AS temps_attente_moyen_min
FROM facts GROUP BY plateforme"""),
    "explore_by_hour": _facts(
        "SELECT heure, plateforme, count(*) AS nombre_trajets FROM facts GROUP BY heure, plateforme"),
    "explore_by_weekday": _facts(f"""
SELECT jour_semaine, {DAY_FR} AS nom_jour_fr, plateforme, count(*) AS nombre_trajets
FROM facts GROUP BY jour_semaine, plateforme"""),
    "explore_by_month": _facts(f"""
SELECT strftime(date_trajet, '%Y-%m') AS annee_mois, plateforme, {_total('revenu_total')} AS revenu_total
FROM facts GROUP BY strftime(date_trajet, '%Y-%m'), plateforme"""),
    "explore_by_zone": _labels("SELECT * FROM by_zone"),
    "explore_zone_labels": _labels("SELECT * FROM labelled"),
    "explore_top15": _labels("""
SELECT zone_id, libelle, nombre_trajets FROM labelled ORDER BY nombre_trajets DESC, zone_id LIMIT 15"""),
    "explore_zone_table": _labels(
        "SELECT zone_id, libelle, nombre_trajets, revenu_total, revenu_moyen FROM labelled"),
    "explore_preview": _facts("""
SELECT * FROM facts
ORDER BY date_trajet NULLS FIRST, plateforme NULLS FIRST, "PULocationID" NULLS FIRST,
  "DOLocationID" NULLS FIRST, trip_miles NULLS FIRST, duree_minutes NULLS FIRST,
  temps_attente_min NULLS FIRST, vitesse_mph NULLS FIRST, base_passenger_fare NULLS FIRST,
  revenu_total NULLS FIRST, tips NULLS FIRST, driver_pay NULLS FIRST, taux_reversement NULLS FIRST,
  a_pourboire, est_partagee, est_pmr
LIMIT 2000"""),
    "explore_row_count": _facts("SELECT count(*) AS nombre_trajets FROM facts"),
    "explore_domains": _zones("""
SELECT DISTINCT 'plateforme' AS domaine, plateforme AS valeur FROM facts
UNION ALL SELECT 'date', CAST(min(date_trajet) AS VARCHAR) FROM facts
UNION ALL SELECT 'date', CAST(max(date_trajet) AS VARCHAR) FROM facts
UNION ALL SELECT DISTINCT 'arrondissement', arrondissement FROM zones WHERE arrondissement IS NOT NULL"""),
}

_COUNTS = ORACLE["warehouse_row_counts"]
ORACLE |= {
    "landed_rows": _with(TRIPS, """
SELECT 'fhvhv_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS name,
       count(*) AS "rows"
FROM raw WHERE pickup_datetime IS NOT NULL GROUP BY 1"""),
    "refreshed_mart": _with(ENRICHED, f"""
SELECT plateforme, {KPI}, (SELECT count(DISTINCT CAST(pickup_datetime AS DATE)) FROM raw
  WHERE strftime(pickup_datetime, '%Y-%m') = '1997-06') AS touched_dates
FROM enriched WHERE strftime(pickup_datetime, '%Y-%m') <> '1997-06' OR trip_miles % 9 = 0 GROUP BY plateforme"""),
    "raw_unified_drift": _with(TRIPS, """
SELECT "PULocationID", count(*) AS trips, count(CASE WHEN l_linenumber <= 3 THEN airport_fee END) AS fees,
       sum("DOLocationID")::BIGINT AS dropoffs
FROM raw GROUP BY 1"""),
    "zones_from_csv": ORACLE["dim_zones"],
    "csv_roundtrip": _with(
        ENRICHED, f"SELECT heure, plateforme, nombre_trajets FROM ({MARTS['trajets_par_heure']})"),
    "loaded_tables": _COUNTS + """
UNION ALL SELECT 'fact_trips', count(*) FROM enriched
UNION ALL SELECT 'dim_zones', count(*) FROM nation""",
    "sample_written": """
SELECT 'lineitem.parquet' AS source_file, least(10, count(*)) AS "rows" FROM lineitem
UNION ALL SELECT 'orders.parquet', least(10, count(*)) FROM orders""",
    "listing": _with(TRIPS, """
SELECT 'fhvhv_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS name, true AS has_bytes,
       count(*) AS "rows"
FROM raw WHERE pickup_datetime IS NOT NULL GROUP BY 1"""),
    "profile": """
SELECT column_name AS "column", CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
       WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS "type",
       (SELECT count(*) FROM lineitem) AS "rows"
FROM duckdb_columns() WHERE table_name = 'lineitem'""",
    "empty_signal": _with(ENRICHED, "\nUNION ALL ".join(
        f"SELECT '{name}' AS plateforme, count(*) = 0 AS empty FROM enriched WHERE plateforme = '{name}'"
        for name in ("Uber", "Nobody"))),
    "stored_preview": ORACLE["explore_preview"],
    **{f"rollup_{name}": ORACLE[name] for name in MARTS},
    **{f"stored_{name}": sql for name, sql in ORACLE.items() if name.startswith("report_")},
}
