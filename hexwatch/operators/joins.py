"""Joins (J1-J4, J6). Sides with one short row per file or entry are counted, and broadcast up to a limit; the big side
then stays where it is. Beyond the limit Spark joins by shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexwatch.functions.hexgrid import with_h3
from hexwatch.functions.times import hour_start, to_utc


#: Rows of at most a few hundred bytes.
MAX_BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The same rows, marked for broadcast if there are few enough."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def join_registry(df: DataFrame, registry: DataFrame, key: str = "dataset_type") -> DataFrame:
    """Attach the dataset's registry entry."""
    entries = registry.withColumnRenamed("dataset_key", key)
    return df.join(small_side(entries), key, "left").withColumn("is_known", F.col("name").isNotNull())


def unseen_files(files: DataFrame, ledger: DataFrame, retry_failed: bool = False, name: str = "file_name") -> DataFrame:
    """Files without a ledger row, whatever its status; `retry_failed` counts only completed ones as seen."""
    seen = ledger.where("status = 'completed'") if retry_failed else ledger
    return files.join(seen.select(F.col("file_name").alias(name)).distinct(), name, "left_anti")


def loaded_counts(gold: DataFrame) -> DataFrame:
    """J3, counting side: rows already stored per source file."""
    return gold.groupBy("source_file").agg(F.count(F.lit(1)).alias("stored_rows"))


def drop_loaded(df: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of files the target does not hold yet. `loaded` has a `source_file`, best from the folded ledger or the
    table's entries, which have one row per file; the stored rows work too."""
    return df.join(small_side(loaded.select("source_file").distinct()), "source_file", "left_anti")


def backfill_dataset_type(crimes: DataFrame, ledger: DataFrame) -> DataFrame:
    """Fill a missing dataset type from the file's ledger row."""
    known = ledger.where("dataset_type is not null").groupBy(F.col("file_name").alias("source_file")).agg(
        F.min("dataset_type").alias("_ledger_type")
    )
    filled = crimes.join(small_side(known), "source_file", "left")
    return filled.withColumn("dataset_type", F.coalesce("dataset_type", "_ledger_type")).select(*crimes.columns)


def locate_requests(requests: DataFrame) -> DataFrame:
    """Requests (latitude, longitude, requested_at) to cell and hour."""
    return with_h3(requests).withColumn("time_window", hour_start(to_utc(F.col("requested_at"))))


def score_requests(requests: DataFrame, scored: DataFrame, risk: str = "risk") -> DataFrame:
    """Risk of each requested place and time; NULL where no feature row exists."""
    table = scored.select("h3_index", "time_window", risk)
    return locate_requests(requests).join(table, ["h3_index", "time_window"], "left")
