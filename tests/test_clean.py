import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from hexwatch.operators import aggregates, clean, columns
from hexwatch.plans import incident
from hexwatch.settings import EXTENDED_HEADERS, SILVER_COLUMNS

RAW = (
    "EVENT_UNIQUE_ID string, OCC_DATE string, OCC_HOUR string, LAT_WGS84 string, LONG_WGS84 string, "
    "MCI_CATEGORY string, NEIGHBOURHOOD_158 string, PREMISES_TYPE string, source_file string, _row_pos bigint"
)
FILE = "major-crime-indicators_1.csv"


def raw_row(key, pos, lat="43.7", lon="-79.4", kind="Assault", file=FILE, date="2024-01-01", hour="5"):
    return (key, date, hour, lat, lon, kind, "1 Here (1)", "House", file, pos)


def test_first_copy_decides(spark):
    raw = spark.createDataFrame([
        raw_row("a", 2, kind="Robbery"), raw_row("a", 1), raw_row("b", 3, lat="0"), raw_row("b", 4),
        raw_row(None, 5), raw_row(None, 6, kind="Robbery"), raw_row("a", 9, file="other.csv", kind="Auto Theft"),
        raw_row("c", 7, kind=None), raw_row("d", 8, date="never"), raw_row("e", 10, lat="43.5", lon="-79.8"),
        raw_row("f", 11, lat="43.9", lon="-79.0"), raw_row("g", 12, lat="43.90001"),
    ], RAW)
    got = incident.silver(raw)
    assert got.columns == SILVER_COLUMNS
    kept = sorted((r.crime_type, r.source_file, r.latitude) for r in got.collect())
    assert kept == sorted([
        ("Assault", FILE, 43.7), ("Assault", FILE, 43.7), ("Auto Theft", "other.csv", 43.7),
        ("Assault", FILE, 43.5), ("Assault", FILE, 43.9),
    ])
    across = incident.silver(raw, across_files=True)
    assert across.where("source_file = 'other.csv'").count() == 0
    assert incident.silver(raw, skip_validation=True).count() == 7  # b and g stay


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A third of the rows share a key: the plan limits each key per task before the exchange."""
    raw = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("EVENT_UNIQUE_ID"),
        F.lit(FILE).alias("source_file"), (F.lit(30_000) - F.col("id")).alias("_row_pos"),
    )
    out = clean.dedup_first(raw)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert out.count() == 20_001
    assert out.where("EVENT_UNIQUE_ID = 'hot'").first()["_row_pos"] == 30_000 - 29_997


@pytest.mark.parametrize("partitions", [1, 7])
def test_dedup_does_not_depend_on_partitioning(spark, partitions):
    df = spark.range(500).select(
        (F.col("id") % 50).cast("string").alias("EVENT_UNIQUE_ID"), F.lit(FILE).alias("source_file"),
        (F.col("id") * 7919 % 500).alias("_row_pos"), F.col("id"),
    ).repartition(partitions)
    want = {}
    for r in df.collect():
        if r["_row_pos"] < want.get(r.EVENT_UNIQUE_ID, (10**9,))[0]:
            want[r.EVENT_UNIQUE_ID] = (r["_row_pos"], r.id)
    assert {r.EVENT_UNIQUE_ID: (r["_row_pos"], r.id) for r in clean.dedup_first(df).collect()} == want


def test_without_key_column_whole_rows_are_distinct(spark):
    raw = spark.createDataFrame(
        [raw_row("x", 1), raw_row("x", 2), raw_row("x", 3, kind="Robbery"), raw_row("x", 4, file="b.csv")], RAW
    ).drop("EVENT_UNIQUE_ID").withColumn("event_unique_id", F.lit("other case does not count"))
    assert clean.dedup_first(raw).count() == 3
    assert clean.dedup_first(raw, across_files=True).count() == 2
    assert incident.silver(raw).count() == 3


def test_mixed_layouts(spark):
    first = spark.createDataFrame([raw_row("a", 1), raw_row("a", 2)], RAW)
    second = first.drop("EVENT_UNIQUE_ID", "PREMISES_TYPE", "OCC_HOUR").withColumnRenamed("LAT_WGS84", "Latitude")
    got = rows(incident.silver([first, second]).select("occurred_at", "premise_type"))
    assert sorted((t.hour, p) for t, p in got if p) == [(5, "House")]
    assert [(t.hour, p) for t, p in got if p is None] == [(0, None)]


def test_resolution_order():
    assert columns.resolve_coordinates(["LAT", "Latitude", "LON", "x", "long_wgs84"]) == ("Latitude", "long_wgs84")
    assert columns.resolve_date_hour(["OCC_DATE", "occ_hour", "OCCURRENCE_DATE"]) == ("OCCURRENCE_DATE", "occ_hour")
    assert columns.resolve_category(["crime_type", "mci_category"]) == "mci_category"
    assert columns.resolve_category(["major_crime_indicator", "CRIME_TYPE"]) == "major_crime_indicator"
    assert columns.resolve_neighbourhood(["HOOD", "Neighborhood_1", "NEIGHBOURHOOD_2"]) == "Neighborhood_1"
    assert columns.resolve_premise(["x"]) is None
    assert columns.resolve_headers([" LAT ", "latitude", "hood"]) == {"lat": " LAT ", "neighbourhood": "hood"}
    assert set(EXTENDED_HEADERS) <= {"occurrence_date", "lat", "long", "neighbourhood", "occurrence_time"}
    for call, names in ((columns.resolve_coordinates, ["lat"]), (columns.resolve_date_hour, ["date"]), (columns.resolve_category, ["x"])):
        with pytest.raises(ValueError):
            call(names)


def test_funnel_counts_each_stage(spark):
    raw = spark.createDataFrame(
        [raw_row("a", 1), raw_row("a", 2), raw_row("b", 3, lat="0"), raw_row("c", 4, kind=None)], RAW)
    got = rows(aggregates.stage_funnel(incident.cleaned(raw)).select("stage", "row_count", "removed"))
    assert got == [("initial", 4, 0), ("deduplicated", 3, 1), ("in_region", 2, 1), ("complete", 1, 1)]
    empty = aggregates.stage_funnel(incident.cleaned(raw.limit(0)))
    assert [r.row_count for r in empty.collect()] == [0, 0, 0, 0]
