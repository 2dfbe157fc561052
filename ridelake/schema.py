"""Names, bounds and lookup values of the trip data model."""

from __future__ import annotations

# Licence code -> platform, anything else is OTHER_PLATFORM.
PLATFORMS = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}
OTHER_PLATFORM = "Autre"

# Plausibility bounds of a trip.
MIN_TRIP_SECONDS = 60
MAX_TRIP_SECONDS = 18000
MAX_TRIP_MILES = 200

# Weekday names, Sunday first, as numbered by dayofweek().
DAYS_EN = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
DAYS_FR = ["Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"]

# The columns that enrichment adds to the raw ones.
DERIVED_COLUMNS = [
    "plateforme", "duree_minutes", "temps_attente_min", "vitesse_mph", "revenu_total",
    "taux_reversement", "a_pourboire", "est_partagee", "est_pmr", "date_trajet", "annee",
    "mois", "heure", "jour_semaine", "nom_jour", "est_weekend",
]

# The columns of the fact table, partitioned by FACT_PARTITION.
FACT_COLUMNS = [
    "plateforme", "PULocationID", "DOLocationID", "trip_miles", "duree_minutes",
    "temps_attente_min", "vitesse_mph", "base_passenger_fare", "revenu_total", "tips",
    "driver_pay", "taux_reversement", "a_pourboire", "est_partagee", "est_pmr",
    "date_trajet", "annee", "mois", "heure", "jour_semaine", "nom_jour", "est_weekend",
]
FACT_TABLE = "trajets_nettoyes"
FACT_PARTITION = "date_trajet"

# Partition column of the star-schema fact table.
STAR_PARTITION = "pickup_date"

# What a CSV cell may hold in place of a missing zone text.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
