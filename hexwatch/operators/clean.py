"""Cleaning operators: deduplication (W1, U1), region filters (P6-P8), projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexwatch.functions import naming, numbers, text, times
from hexwatch.operators import columns as names
from hexwatch.settings import (
    DATASETS,
    RAW_KEY,
    REGION,
    SILVER_CRITICAL,
    TEXT_WIDTHS,
    Box,
)
from hexwatch.sources.bronze import ROW_POS, SOURCE_FILE

RAW_FIELDS = ["raw_date", "raw_hour", "raw_lat", "raw_lon", "raw_category", "raw_neighbourhood", "raw_premise"]


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key. Spark keeps one row per key and map task before the shuffle (WindowGroupLimit), so a key
    that holds a large share of the rows sends at most one row per task to its reducer."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def dedup_first(df: DataFrame, key: str = RAW_KEY, across_files: bool = False) -> DataFrame:
    """First row in file order per key, per file; NULL keys count as one key. Without the (case-sensitive) key
    column, U1: distinct whole rows."""
    if key not in df.columns:
        return distinct_rows(df, across_files)
    if across_files:
        return keep_first(df, [key], [SOURCE_FILE, ROW_POS])
    # The key leads: it tells rows apart in the sort's 8-byte prefix, file names mostly share theirs.
    return keep_first(df, [key, SOURCE_FILE], [ROW_POS])


def distinct_rows(df: DataFrame, across_files: bool = False) -> DataFrame:
    """Distinct over the source columns, within each file or over all of them."""
    rows = df.drop(ROW_POS)
    if not across_files:
        return rows.distinct()
    content = [c for c in rows.columns if c != SOURCE_FILE]
    return rows.groupBy(*content).agg(F.min(SOURCE_FILE).alias(SOURCE_FILE))


def canonical(df: DataFrame) -> DataFrame:
    """One file layout to fixed raw column names (P2-P5). Only the columns the cleaning step needs survive, so the
    deduplication shuffle carries nothing else. The key column stays when the layout has one."""
    lat, lon = names.resolve_coordinates(df.columns)
    date, hour = names.resolve_date_hour(df.columns)
    found = {
        "raw_date": date,
        "raw_hour": hour,
        "raw_lat": lat,
        "raw_lon": lon,
        "raw_category": names.resolve_category(df.columns),
        "raw_neighbourhood": names.resolve_neighbourhood(df.columns),
        "raw_premise": names.resolve_premise(df.columns),
    }
    cols = [(F.col(f"`{c}`") if c else F.lit(None)).cast("string").alias(raw) for raw, c in found.items()]
    carried = [c for c in (RAW_KEY, SOURCE_FILE, ROW_POS) if c in df.columns]
    return df.select(*[F.col(c) for c in carried], *cols)


def in_box(lat: Column, lon: Column, box: Box = REGION) -> Column:
    return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)


def filter_region(df: DataFrame, lat: str = "latitude", lon: str = "longitude", box: Box = REGION) -> DataFrame:
    """Rows whose coordinates lie in the box, edges included; missing coordinates are outside."""
    return df.where(in_box(F.col(lat), F.col(lon), box))


def with_coordinates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "latitude": numbers.to_number(F.col("raw_lat")),
        "longitude": numbers.to_number(F.col("raw_lon")),
    })


def to_silver_schema(df: DataFrame, keys=tuple(DATASETS), formats: list[str] | None = None) -> DataFrame:
    """Canonical rows with coordinates to the eight cleaned columns; key and row position stay when present.
    `formats` adds date formats."""
    carried = [F.col(c) for c in (RAW_KEY, ROW_POS) if c in df.columns]
    return df.select(
        *carried,
        times.parse_occurred_at(F.col("raw_date"), F.col("raw_hour"), formats).alias("occurred_at"),
        "latitude",
        "longitude",
        text.clean_category(F.col("raw_category")).alias("crime_type"),
        text.clean_neighbourhood(F.col("raw_neighbourhood")).alias("neighbourhood"),
        text.clean_premise(F.col("raw_premise")).alias("premise_type"),
        SOURCE_FILE,
        naming.dataset_type_of(F.col(SOURCE_FILE), keys).alias("dataset_type"),
    )


def drop_missing_critical(df: DataFrame) -> DataFrame:
    """P9."""
    return df.na.drop(subset=SILVER_CRITICAL)


def truncate_text(df: DataFrame) -> DataFrame:
    """P13."""
    return df.withColumns({c: text.truncate(F.col(c), n) for c, n in TEXT_WIDTHS.items() if c in df.columns})


def with_domain_flag(df: DataFrame, col: str = "crime_type") -> DataFrame:
    """Flag, not filter."""
    return df.withColumn("in_domain", text.in_domain(F.col(col)))
