"""Validation and verification (V1-V8, A16). Each returns rows (check, passed, value), one aggregation per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.functions.numbers import to_number
from hexwatch.operators.columns import resolve_headers
from hexwatch.settings import (
    CATEGORIES,
    MISSING_WARN_PCT,
    OPTIONAL_HEADERS,
    RAW_REGION,
    REGION,
    REQUIRED_HEADERS,
    Box,
)
from hexwatch.sources.bronze import ROW_POS, SOURCE_FILE

ROWS = "*"


def _check(name: str, passed: Column, value: Column, level: str = "error") -> Column:
    return F.struct(
        F.lit(name).alias("check"), F.lit(level).alias("level"),
        F.coalesce(passed, F.lit(False)).alias("passed"), value.cast("double").alias("value"),
    )


def validate_structure(spark: SparkSession, columns: list[str], extended: bool = False) -> list[tuple]:
    """V1 on header names: (check, level, passed, value) per required and optional logical column."""
    found = resolve_headers(columns, extended)
    rows = [(f"has {c}", "error", c in found, float(c in found)) for c in REQUIRED_HEADERS]
    return rows + [(f"has {c}", "warning", c in found, float(c in found)) for c in OPTIONAL_HEADERS]


def _validated(raw: DataFrame, extended: bool, by: str | None) -> DataFrame:
    """V1 + V2 + V3 per file with the file's row count: structure, coordinate ranges (the wider box), missing shares of required columns.

    Ranges and shares are judged only when the structure is sound. One pass over the rows.
    """
    columns = [c for c in raw.columns if c not in (SOURCE_FILE, ROW_POS)]
    found = resolve_headers(columns, extended)
    structure = validate_structure(raw.sparkSession, columns, extended)
    keys = [by] if by else []
    checks = [_check(name, F.lit(ok), F.lit(value), level) for name, level, ok, value in structure]
    aggregates = [F.count(ROWS).alias("_rows")]
    if all(c in found for c in REQUIRED_HEADERS):
        for logical, low, high in (
            ("lat", RAW_REGION.lat_min, RAW_REGION.lat_max),
            ("long", RAW_REGION.lon_min, RAW_REGION.lon_max),
        ):
            number = to_number(F.col(f"`{found[logical]}`"))
            outside = F.count_if(number.isNull() | ~number.between(low, high))
            aggregates.append(outside.alias(f"_bad_{logical}"))
            checks.append(_check(f"{logical} in range", F.col(f"_bad_{logical}") == 0, F.col(f"_bad_{logical}")))
        for logical in REQUIRED_HEADERS:
            missing = F.count_if(F.col(f"`{found[logical]}`").isNull()) * 100.0 / F.count(ROWS)
            aggregates.append(missing.alias(f"_missing_{logical}"))
            share = F.col(f"_missing_{logical}")
            checks.append(_check(f"{logical} mostly present", share <= MISSING_WARN_PCT, share, "warning"))
    return raw.groupBy(*keys).agg(*aggregates).select(*keys, "_rows", F.inline(F.array(*checks)))


def validate_raw(raw: DataFrame, extended: bool = False, by: str | None = SOURCE_FILE) -> DataFrame:
    """V1 + V2 + V3 per file: (check, level, passed, value) rows."""
    return _validated(raw, extended, by).drop("_rows")


def file_profile(raw: DataFrame, extended: bool = False) -> DataFrame:
    """A16 + V3: one report row per file."""
    columns = [c for c in raw.columns if c not in (SOURCE_FILE, ROW_POS)]
    mapping = ", ".join(f"{k}={v}" for k, v in sorted(resolve_headers(columns, extended).items()))
    failed = ~F.col("passed")
    # The checks of a file come from one row, so the second aggregation is over a few rows per file.
    report = _validated(raw, extended, SOURCE_FILE).groupBy(SOURCE_FILE).agg(
        F.first("_rows").alias("row_count"),
        F.count_if(failed & (F.col("level") == "error")).alias("errors"),
        F.count_if(failed & (F.col("level") == "warning")).alias("warnings"),
    )
    return report.select(
        SOURCE_FILE, "row_count", F.lit(len(columns)).alias("column_count"), F.lit(mapping).alias("column_mapping"),
        "errors", "warnings", (F.col("errors") == 0).alias("is_valid"),
    )


def verify_silver(silver: DataFrame, box: Box = REGION) -> DataFrame:
    """V4: seven checks over the whole table; `value` is the number of offending rows."""
    lat, lon = F.col("latitude"), F.col("longitude")
    bad = {
        "no nulls in occurred_at": F.col("occurred_at").isNull(),
        "no nulls in latitude": lat.isNull(),
        "no nulls in longitude": lon.isNull(),
        "no nulls in crime_type": F.col("crime_type").isNull(),
        "latitude in region": ~F.coalesce(lat.between(box.lat_min, box.lat_max), F.lit(False)),
        "longitude in region": ~F.coalesce(lon.between(box.lon_min, box.lon_max), F.lit(False)),
        "crime types in domain": ~F.coalesce(F.col("crime_type").isin(*CATEGORIES), F.lit(False)),
    }
    counted = silver.agg(*[F.count_if(c).alias(f"_{i}") for i, c in enumerate(bad.values())])
    checks = [_check(name, F.col(f"_{i}") == 0, F.col(f"_{i}")) for i, name in enumerate(bad)]
    return counted.select(F.inline(F.array(*checks)))


def verify_gold(gold: DataFrame) -> DataFrame:
    """V5: an empty table fails every check."""
    counted = gold.agg(
        F.count(ROWS).alias("total"), F.count("h3_index").alias("cells"), F.count("geom").alias("points"),
        F.countDistinct("h3_index").alias("distinct_cells"),
    )
    some = F.col("total") > 0
    return counted.select(F.inline(F.array(
        _check("records exist", some, F.col("total")),
        _check("all records have a cell", some & (F.col("cells") == F.col("total")), F.col("cells")),
        _check("all records have a point", some & (F.col("points") == F.col("total")), F.col("points")),
        _check("several cells", some & (F.col("distinct_cells") > 1), F.col("distinct_cells")),
    )))


def verify_load(gold: DataFrame, expected: DataFrame) -> DataFrame:
    """V6: per expected (source_file, expected_count), all stored rows are there with cell and point."""
    stored = gold.groupBy("source_file").agg(
        F.count(ROWS).alias("actual_count"), F.count("h3_index").alias("cell_count"), F.count("geom").alias("point_count")
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("actual_count", "cell_count", "point_count")]
    joined = expected.join(stored, "source_file", "left").select("source_file", "expected_count", *counts)
    same = [F.col(c) == F.col("expected_count") for c in ("actual_count", "cell_count", "point_count")]
    return joined.withColumn("passed", same[0] & same[1] & same[2])


def load_summary(tagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """V7 from `with_reject_reason`: every row counts once, as loaded or failed."""
    ok = F.count_if(F.col("reject_reason").isNull())
    return tagged.groupBy(*(by or [])).agg(
        ok.alias("successful"), F.count("reject_reason").alias("failed"),
        F.try_divide(ok * 100.0, F.count(ROWS)).alias("success_pct"),
    )


def verify_tables(spark: SparkSession, tables: list[str]) -> DataFrame:
    """V8: which tables exist, and their exact row counts (one lazy union over the present ones)."""
    out = None
    for name in tables:
        present = spark.catalog.tableExists(name)
        rows = spark.table(name).agg(F.count(ROWS).alias("row_count")) if present else spark.range(1).select(
            F.lit(None).cast("bigint").alias("row_count")
        )
        row = rows.select(F.lit(name).alias("table_name"), F.lit(present).alias("present"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out
