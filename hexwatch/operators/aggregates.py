"""Counts, distributions and profiles (A1-A17, T1-T4). All aggregates combine on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexwatch.functions.times import day_start, hour_start
from hexwatch.operators.clean import in_box
from hexwatch.settings import RAW_KEY, TEXT_WIDTHS
from hexwatch.sources.bronze import ROW_POS, SOURCE_FILE

ROWS = "*"


def counts_by_cell_hour(gold: DataFrame) -> DataFrame:
    """A1. The distinct count is planned as a pre-aggregation by (cell, hour, type), so a busy cell is combined
    before it meets in one place."""
    return gold.groupBy("h3_index", hour_start(F.col("occurred_at")).alias("time_window")).agg(
        F.count(ROWS).alias("crime_count"), F.countDistinct("crime_type").alias("distinct_crime_types")
    )


def summary(gold: DataFrame, approximate: bool = False) -> DataFrame:
    """A2 + A3 + A4 + A5 in one pass. `approximate` replaces the exact distinct cell count by a sketch."""
    cells = F.approx_count_distinct("h3_index") if approximate else F.countDistinct("h3_index")
    return gold.agg(
        F.count(ROWS).alias("total"),
        F.count("h3_index").alias("with_cell"),
        F.count("geom").alias("with_point"),
        cells.alias("distinct_cells"),
        F.min("occurred_at").alias("first_at"),
        F.max("occurred_at").alias("last_at"),
    )


def distribution(df: DataFrame, key: str, count: str = "crime_count") -> DataFrame:
    """Rows per value, largest first."""
    return df.groupBy(key).agg(F.count(ROWS).alias(count)).orderBy(F.desc(count), F.asc_nulls_last(key))


def daily_counts(gold: DataFrame, dataset_type: str) -> DataFrame:
    """A9 + P15: days of one dataset, newest first. The filter prunes partitions of the stored table."""
    return (
        gold.where(F.col("dataset_type") == dataset_type)
        .groupBy("dataset_type", day_start(F.col("occurred_at")).alias("day"))
        .agg(F.count(ROWS).alias("crime_count"))
        .orderBy(F.desc("day"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """A10: one aggregate over all columns, then one row per column."""
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], counted.columns, "column_name", "null_count")


def missing_percentages(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Share of missing values in percent, per column and optional group."""
    keys = keys or []
    shares = [(F.count_if(F.col(f"`{c}`").isNull()) * 100.0 / F.count(ROWS)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*shares).unpivot(keys, columns, "column_name", "missing_pct")


def coordinate_ranges(df: DataFrame) -> DataFrame:
    """A12."""
    return df.agg(
        F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max"),
    )


def sorted_values(df: DataFrame, col: str) -> DataFrame:
    """A13 as rows, so the number of values has no bound."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def file_load_stats(gold: DataFrame) -> DataFrame:
    """A14."""
    return gold.groupBy("source_file").agg(
        F.count(ROWS).alias("record_count"), F.max("occurred_at").alias("last_timestamp")
    )


def stage_funnel(cleaned: DataFrame) -> DataFrame:
    """Rows left after each cleaning stage, removed rows and percent, from one pass over cleaned columns
    (`plans.incident.cleaned`).

    Per key, the first row decides how far the event gets. Position and stage are numbers, so this is a hash
    aggregate that combines on the map side: a key with very many copies costs one row per task.
    """
    region = F.coalesce(in_box(F.col("latitude"), F.col("longitude")), F.lit(False))
    complete = F.col("occurred_at").isNotNull() & F.col("crime_type").isNotNull()
    stage = F.when(region & complete, 2).when(region, 1).otherwise(0)
    # Without a key, equal rows of a file are one event.
    keys = [SOURCE_FILE, RAW_KEY] if RAW_KEY in cleaned.columns else [c for c in cleaned.columns if c != ROW_POS]
    events = cleaned.select(*keys, ROW_POS, stage.alias("stage")).groupBy(*keys).agg(
        F.count(ROWS).alias("copies"), F.min_by("stage", ROW_POS).alias("stage")
    )
    totals = events.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("initial"),
        F.count(ROWS).alias("deduplicated"),
        F.count_if(F.col("stage") >= 1).alias("in_region"),
        F.count_if(F.col("stage") >= 2).alias("complete"),
    )
    order = ["initial", "deduplicated", "in_region", "complete"]
    before = dict(zip(order[1:], order))
    steps = [
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(name).alias("row_count"),
            (F.col(before.get(name, name)) - F.col(name)).alias("removed"),
            F.coalesce(
                F.try_divide((F.col(before.get(name, name)) - F.col(name)) * 100.0, F.col(before.get(name, name))),
                F.lit(0.0),
            ).alias("removed_pct"),
        )
        for i, name in enumerate(order)
    ]
    return totals.select(F.inline(F.array(*steps)))


def max_lengths(df: DataFrame, widths: dict[str, int] = TEXT_WIDTHS) -> DataFrame:
    """Longest text per column against its stored width."""
    present = [c for c in widths if c in df.columns]
    longest = df.agg(*[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(c) for c in present])
    rows = longest.unpivot([], present, "column_name", "max_length")
    limit = F.element_at(F.create_map(*[F.lit(x) for c in present for x in (c, widths[c])]), F.col("column_name"))
    return rows.withColumn("is_truncated", F.col("max_length") > limit)


def newest_rows(df: DataFrame, by: str, n: int = 5, tie: str | None = None) -> DataFrame:
    """A top-k plan, each task keeps its n best rows; `tie` orders equal times."""
    return df.orderBy(F.desc(by), *([tie] if tie else [])).limit(n)


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)
