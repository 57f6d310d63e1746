"""Loaded (gold) table: sinks (S6), quarantine, scan.

The table is a folder of loads, each partitioned by dataset type, and a small table of entries that says which loads
hold a file's rows. Loading a file again adds a load and an entry that replaces the earlier ones, so a load is visible only when
its entry is written, old rows of a file never show whatever their dataset type was, and a file without rows replaces
its rows by none. Rows that the table refuses are kept beside the others under their reason.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.settings import GOLD_COLUMNS, GOLD_REQUIRED, GOLD_SCHEMA, JDBC_BATCH_ROWS, TEXT_WIDTHS

ENTRY_SCHEMA = "source_file string, load_id bigint, replaces boolean"
STORED_SCHEMA = f"{GOLD_SCHEMA}, reject_reason string, load_id bigint, refused boolean"
#: Entries are one short row per file and load; up to so many are broadcast, more are joined by shuffle.
MAX_BROADCAST_ENTRIES = 200_000


def with_reject_reason(df: DataFrame) -> DataFrame:
    """The first reason why the target table would refuse a row, NULL for a loadable row."""
    reason = None
    for c in GOLD_REQUIRED:
        test = F.col(c).isNull()
        reason = F.when(test, f"missing {c}") if reason is None else reason.when(test, f"missing {c}")
    for c, width in TEXT_WIDTHS.items():
        reason = reason.when(F.length(c) > width, f"{c} too long")
    return df.withColumn("reject_reason", reason)


def split_loadable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to load and rows to quarantine: decided before the write, so no batch has to be retried row by row."""
    tagged = with_reject_reason(df)
    return tagged.where("reject_reason is null").drop("reject_reason"), tagged.where("reject_reason is not null")


def write_gold(df: DataFrame, path: str, mode: str = "replace", files: list[str] | None = None) -> None:
    """Add a load; rows ordered by cell and time inside each file.

    `replace`: the rows of the files in `df`, and of those in `files`, are these and no others; `append` adds to them.
    Rows with a `reject_reason` go to the quarantine. The rebalance lets adaptive execution split a dataset that is much
    larger than the others and merge small ones; the order makes row-group statistics useful for cell and time filters.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be replace or append, is {mode!r}")
    spark = df.sparkSession
    # Later than every earlier load, also if clocks differ between drivers.
    load_id = max(time.time_ns(), 1 + (entries_of(spark, path).agg(F.max("load_id")).first()[0] or 0))
    tagged = df if "reject_reason" in df.columns else df.withColumn("reject_reason", F.lit(None).cast("string"))
    arranged = (
        tagged.withColumns({"load_id": F.lit(load_id), "refused": F.col("reject_reason").isNotNull()})
        .hint("rebalance", "refused", "dataset_type")
        .sortWithinPartitions("refused", "dataset_type", "h3_index", "occurred_at")
    )
    arranged.write.mode("append").partitionBy("load_id", "refused", "dataset_type").parquet(f"{path}/rows")
    loaded = spark.read.schema(STORED_SCHEMA).parquet(f"{path}/rows").where(F.col("load_id") == load_id).select("source_file")
    if files:
        loaded = loaded.union(spark.createDataFrame([(f,) for f in files], "source_file string"))
    entries = loaded.distinct().select("source_file", F.lit(load_id).alias("load_id"), F.lit(mode == "replace").alias("replaces"))
    publish(entries, path)


def publish(entries: DataFrame, path: str) -> None:
    """From here on the load shows."""
    entries.coalesce(1).write.mode("append").parquet(f"{path}/entries")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def entries_of(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/entries", ENTRY_SCHEMA)


def live_loads(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, load_id) of the loads that count: a file's last replacing load and what was appended after it."""
    entries = entries_of(spark, path)
    since = entries.groupBy("source_file").agg(F.coalesce(F.max(F.when(F.col("replaces"), F.col("load_id"))), F.lit(0)).alias("since"))
    if since.count() <= MAX_BROADCAST_ENTRIES:
        since = F.broadcast(since)
    return entries.join(since, "source_file").where(F.col("load_id") >= F.col("since")).select("source_file", "load_id").distinct()


def _current(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the loads that count."""
    live = live_loads(spark, path)
    if live.count() <= MAX_BROADCAST_ENTRIES:
        live = F.broadcast(live)
    return spark.read.schema(STORED_SCHEMA).parquet(f"{path}/rows").join(live, ["source_file", "load_id"], "left_semi")


def vacuum(spark: SparkSession, path: str, keep_hours: float = 168.0) -> list[int]:
    """Remove the loads whose rows no longer show, and return their ids: replaced ones, and those that were cut off before
    their entries were written. Loads younger than `keep_hours` stay, for queries that still read them and for loads under
    way. The folder names and one row per load reach the driver, never rows or files."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    rows = hadoop.Path(f"{path}/rows")
    fs = rows.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(rows):
        return []
    live = {r["load_id"] for r in live_loads(spark, path).select("load_id").distinct().collect()}
    newest = time.time_ns() - int(keep_hours * 3600 * 1e9)
    gone = []
    for status in fs.listStatus(rows):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("load_id=") and (load_id := int(name.removeprefix("load_id="))) not in live and load_id < newest:
            fs.delete(status.getPath(), True)
            gone.append(load_id)
    return sorted(gone)


def scan_gold(spark: SparkSession, path: str) -> DataFrame:
    return _current(spark, path).where(~F.col("refused")).select(*GOLD_COLUMNS, "geom")


def scan_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Refused rows of the current loads with their reason."""
    return _current(spark, path).where("refused").select(*GOLD_COLUMNS, "geom", "reject_reason")


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
    batch_rows: int = JDBC_BATCH_ROWS, connections: int = 8,
) -> None:
    """Append to a database table in batches, with a bounded number of connections. The point struct stays behind:
    the database derives its own geometry column."""
    flat = df.drop("geom")
    writer = flat.write.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.option("batchsize", batch_rows).option("numPartitions", connections).mode("append").save()
