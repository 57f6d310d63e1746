"""Fixed values of the incident domain. They decide results, so they are stated plainly here and nowhere else."""

from __future__ import annotations

from typing import NamedTuple


class Box(NamedTuple):
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# Accepted region, and the wider box of the raw-file check.
REGION = Box(43.5, 43.9, -79.8, -79.0)
RAW_REGION = Box(43.0, 44.0, -80.0, -79.0)

H3_RESOLUTION = 9
SRID = 4326
JDBC_BATCH_ROWS = 10_000
MISSING_WARN_PCT = 10.0

# Category domain and the spellings that map onto it (compared in lower case).
CATEGORIES = ["Assault", "Robbery", "Break and Enter", "Auto Theft", "Theft Over"]
CATEGORY_SPELLINGS = {
    "Assault": ["assault"],
    "Robbery": ["robbery"],
    "Break and Enter": ["break and enter", "break & enter", "b&e"],
    "Auto Theft": ["auto theft"],
    "Theft Over": ["theft over", "theftover"],
}

# CSV cell texts that mean "missing".
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Raw column names understood by the cleaning step (upper case).
RAW_KEY = "EVENT_UNIQUE_ID"
LAT_NAMES = ["LAT_WGS84", "LAT", "LATITUDE"]
LON_NAMES = ["LONG_WGS84", "LONG", "LONGITUDE", "LON"]
CATEGORY_NAME = "MCI_CATEGORY"
CATEGORY_FALLBACK_NAMES = ["CRIME_TYPE", "MAJOR_CRIME_INDICATOR"]
NEIGHBOURHOOD_PARTS = ["NEIGHBOURHOOD", "NEIGHBORHOOD"]
PREMISE_PARTS = ["PREMISES_TYPE", "PREMISE_TYPE"]

# Logical column -> accepted header names of the raw-file check (compared lower case, trimmed).
REQUIRED_HEADERS = {
    "occurrence_date": ["occurrence_date", "occurrence date", "occurrenceyearmonth"],
    "lat": ["lat", "latitude"],
    "long": ["long", "longitude"],
    "major_crime_indicator": [
        "major_crime_indicator", "major crime indicator", "mci_category", "crime_type", "offence",
    ],
}
OPTIONAL_HEADERS = {
    "neighbourhood": ["neighbourhood", "hood"],
    "premise_type": ["premises_type", "premises type", "premise_type", "location_type"],
    "occurrence_time": ["occurrence_time", "occurrence time", "time"],
}
# The published header names of current files, which the check above does not know (opt-in).
EXTENDED_HEADERS = {
    "occurrence_date": ["occ_date"],
    "lat": ["lat_wgs84"],
    "long": ["long_wgs84"],
    "neighbourhood": ["neighbourhood_158", "neighbourhood_140"],
    "occurrence_time": ["occ_hour"],
}

# Shapes of date texts. Month-first dates are rewritten year-first; 12-hour times need a formatter.
MONTH_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
YEAR_FIRST = r"^\d{4}(-\d|$)"
HALF_DAY_FORMAT = "M/d/yyyy h:mm:ss a"
# Dates without separators or with month names, told apart by their first characters.
COMPACT_DATE = r"^\d{8}$"
NAMED_MONTH = r"^(\d{1,2}-[A-Za-z]{3}-\d{4}|[A-Za-z]{3,9} \d{1,2}, \d{4})$"
NAMED_MONTH_FORMATS = ["d-MMM-yyyy", "MMMM d, yyyy", "MMM d, yyyy"]

SILVER_COLUMNS = [
    "occurred_at", "latitude", "longitude", "crime_type",
    "neighbourhood", "premise_type", "source_file", "dataset_type",
]
SILVER_REQUIRED = ["occurred_at", "latitude", "longitude", "crime_type", "source_file"]
SILVER_CRITICAL = ["occurred_at", "latitude", "longitude", "crime_type"]
GOLD_COLUMNS = [
    "crime_type", "occurred_at", "latitude", "longitude", "neighbourhood",
    "premise_type", "h3_index", "source_file", "dataset_type",
]
GOLD_REQUIRED = ["crime_type", "occurred_at", "latitude", "longitude", "h3_index", "source_file"]

SILVER_SCHEMA = (
    "occurred_at timestamp_ntz, latitude double, longitude double, crime_type string, "
    "neighbourhood string, premise_type string, source_file string, dataset_type string"
)
GOLD_SCHEMA = (
    "crime_type string, occurred_at timestamp, latitude decimal(10,8), longitude decimal(11,8), "
    "neighbourhood string, premise_type string, h3_index string, "
    "geom struct<x: double, y: double, srid: int>, dataset_type string, source_file string"
)

# Column widths of the stored table.
TEXT_WIDTHS = {
    "crime_type": 100, "neighbourhood": 100, "premise_type": 100,
    "h3_index": 20, "source_file": 255, "dataset_type": 100,
}
ERROR_MESSAGE_WIDTH = 1000

# The published datasets. key -> (name, resource_id, file name, description)
CATALOG_BASE = "https://ckan0.cf.opendata.inter.prod-toronto.ca"
DATASETS = {
    "major-crime-indicators": (
        "Major Crime Indicators", "6f0a0e0e-8c0a-4b3a-9f3a-1e8b3a4f5e6b",
        "major-crime-indicators.csv", "Major crime indicators from Toronto Police Service"),
    "police-annual-statistical-report-shooting-occurrences": (
        "Shooting Occurrences", None,
        "shooting-occurrences.csv", "Annual statistical report on shooting occurrences"),
    "wellbeing-toronto-safety": (
        "Wellbeing Toronto Safety", None,
        "wellbeing-safety.csv", "Wellbeing Toronto safety indicators"),
    "police-annual-statistical-report-reported-crimes": (
        "Reported Crimes", None,
        "reported-crimes.csv", "Annual statistical report on reported crimes"),
    "police-annual-statistical-report-miscellaneous-data": (
        "Miscellaneous Police Data", None,
        "miscellaneous-data.csv", "Miscellaneous police statistical data"),
    "police-annual-statistical-report-homicide": (
        "Homicide Data", None,
        "homicide.csv", "Annual statistical report on homicides"),
    "police-annual-statistical-report-miscellaneous-firearms": (
        "Miscellaneous Firearms", None,
        "miscellaneous-firearms.csv", "Miscellaneous firearms-related data"),
    "theft-from-motor-vehicle": (
        "Theft from Motor Vehicle", None,
        "theft-from-motor-vehicle.csv", "Theft from motor vehicle incidents"),
    "shootings-firearm-discharges": (
        "Shootings and Firearm Discharges", None,
        "shootings-firearm-discharges.csv", "Shootings and firearm discharge incidents"),
}
# Files of the older naming belong to this dataset.
LEGACY_FILE_PREFIX = "toronto_crime_"
LEGACY_DATASET = "major-crime-indicators"
