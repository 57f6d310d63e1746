"""Cleaned (silver) table: sink (S4) and scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.functions.numbers import to_number
from hexwatch.functions.text import missing_to_null
from hexwatch.settings import SILVER_COLUMNS, SILVER_REQUIRED, SILVER_SCHEMA


def write_silver(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Parquet partitioned by dataset type, or headered CSV.

    After the deduplication every task holds rows of every dataset; the rebalance keeps each from writing a sliver of
    each partition, and lets adaptive execution split a dataset that is much larger than the others.
    """
    out = df.select(*SILVER_COLUMNS)
    if fmt == "csv":
        writer = out.write.mode(mode).option("header", "true").option("escape", '"')
        writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    else:
        out.hint("rebalance", "dataset_type").write.mode(mode).partitionBy("dataset_type").format(fmt).save(path)


def scan_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fixed schema; a missing required column is an error, a missing required value drops the row."""
    if fmt == "csv":
        raw = spark.read.option("header", "true").option("escape", '"').csv(path)
        _require(raw.columns)
        cell = {c: missing_to_null(F.col(c)) for c in raw.columns}
        cell["occurred_at"] = cell["occurred_at"].try_cast("timestamp_ntz")
        for c in ("latitude", "longitude"):
            cell[c] = to_number(F.col(c))
        df = raw.select(*[cell[c].alias(c) for c in raw.columns])
    else:
        # Column presence comes from the file footers; the read itself uses the fixed schema.
        _require(spark.read.format(fmt).load(path).columns)
        df = spark.read.schema(SILVER_SCHEMA).format(fmt).load(path)
    return df.na.drop(subset=SILVER_REQUIRED)


def _require(columns: list[str]) -> None:
    absent = [c for c in SILVER_REQUIRED if c not in columns]
    if absent:
        raise ValueError(f"required columns absent: {absent}")
