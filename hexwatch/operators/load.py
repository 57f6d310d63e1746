"""Silver to gold: cell assignment (P7, H1, P10) and the stored schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexwatch.functions import numbers, text, times
from hexwatch.functions.hexgrid import make_point, with_h3
from hexwatch.operators.clean import filter_region, truncate_text
from hexwatch.settings import GOLD_COLUMNS, GOLD_REQUIRED, TEXT_WIDTHS


def with_cells(df: DataFrame) -> DataFrame:
    """P7 + H1: re-check the region and add the cell, NULL where there is none."""
    return with_h3(filter_region(df))


def assign_cells(df: DataFrame) -> DataFrame:
    """P7 + H1 + P10: re-check the region, add the cell, drop rows without one."""
    return with_cells(df).where(F.col("h3_index").isNotNull())


def to_gold_schema(df: DataFrame, source_tz: str | None = None, complete: bool = True) -> DataFrame:
    """Nine columns in order (absent ones NULL), UTC times, decimal coordinates (NULL where one does not fit), bounded
    text, plus the point. Rows that lack a required value are dropped unless `complete` is switched off."""
    absent = [c for c in GOLD_COLUMNS if c not in df.columns]
    full = df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df
    cell = {c: text.nan_to_null(F.col(c)) for c in TEXT_WIDTHS}
    cell["occurred_at"] = times.to_utc(F.col("occurred_at"), source_tz)
    cell["latitude"] = numbers.lat_decimal(F.col("latitude"))
    cell["longitude"] = numbers.lon_decimal(F.col("longitude"))
    typed = full.select(*[cell[c].alias(c) for c in GOLD_COLUMNS], make_point("longitude", "latitude").alias("geom"))
    bounded = truncate_text(typed)
    return bounded.na.drop(subset=GOLD_REQUIRED) if complete else bounded
