"""Ingestion ledger (L1-L5): an append-only event table and the fold that gives one current row per file.

Events: start, complete, fail, gold_complete, forget. Appending needs no row locks, and the fold is a single aggregation whose
rules per field follow from which events touch that field.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.functions.text import truncate
from hexwatch.operators.aggregates import newest_rows
from hexwatch.settings import ERROR_MESSAGE_WIDTH

EVENT_SCHEMA = (
    "file_name string, kind string, seq bigint, at timestamp, record_count bigint, "
    "last_timestamp timestamp, error_message string, dataset_type string"
)


def event(
    df: DataFrame, kind: str, seq: Column, at: Column | None = None, record_count: Column | None = None,
    last_timestamp: Column | None = None, error_message: Column | None = None, dataset_type: Column | None = None,
) -> DataFrame:
    """Ledger events of one kind, one per row of `df(file_name, ...)`. `seq` orders the events of a file."""
    def typed(c: Column | None, t: str) -> Column:
        return (F.lit(None) if c is None else c).cast(t)

    return df.select(
        F.col("file_name"),
        F.lit(kind).alias("kind"),
        seq.cast("bigint").alias("seq"),
        (F.current_timestamp() if at is None else at).cast("timestamp").alias("at"),
        typed(record_count, "bigint").alias("record_count"),
        typed(last_timestamp, "timestamp").alias("last_timestamp"),
        truncate(typed(error_message, "string"), ERROR_MESSAGE_WIDTH).alias("error_message"),
        typed(dataset_type, "string").alias("dataset_type"),
    )


def fold(events: DataFrame) -> DataFrame:
    """Current state per file.

    start: creates the row or sets it in progress with a new time and count; complete: sets count, last time, clears
    the error; fail: sets the error only; gold_complete: complete without a dataset type. A dataset type is replaced
    only by a known one; forget removes the row, so that the file is loaded again. Events before the file's first start
    change nothing.
    """
    return current(partial(events))


def partial(events: DataFrame) -> DataFrame:
    """Per file what the fold needs to know of its events: each field's last value with the number of the event that set it.

    Two such rows of a file merge into one, so a snapshot of them stands for all events before it.
    """
    kind, seq = F.col("kind"), F.col("seq")
    done = kind.isin("complete", "gold_complete")
    failed = kind == "fail"
    typed = kind.isin("start", "complete") & F.col("dataset_type").isNotNull()
    state = F.when(kind == "start", "in_progress").when(done, "completed").when(kind == "forget", "forgotten").otherwise("failed")
    message = F.when(failed, truncate(F.col("error_message"), ERROR_MESSAGE_WIDTH))

    def last(value: Column, when: Column) -> Column:
        return F.max_by(F.struct(seq.alias("seq"), value.alias("value")), F.when(when, seq))

    return events.groupBy("file_name").agg(
        F.min(F.when(kind == "start", seq)).alias("first"),
        last(F.col("at"), kind == "start").alias("ingested_at"),
        last(F.col("record_count"), (kind == "start") | done).alias("record_count"),
        last(F.col("last_timestamp"), done).alias("last_timestamp"),
        last(state, F.lit(True)).alias("status"),
        last(message, done | failed).alias("error_message"),
        last(F.col("dataset_type"), typed).alias("dataset_type"),
        F.max(seq).alias("seq"),
    )


FOLDED = ("ingested_at", "record_count", "last_timestamp", "status", "error_message", "dataset_type")


def merged(parts: DataFrame) -> DataFrame:
    """One row per file from partial rows: of every field the value with the greatest number."""
    return parts.groupBy("file_name").agg(
        F.min("first").alias("first"), *(F.max_by(c, F.col(f"{c}.seq")).alias(c) for c in FOLDED), F.max("seq").alias("seq"))


def current(parts: DataFrame) -> DataFrame:
    """The state that partial rows, one per file, stand for."""
    first = F.col("first")

    def since(c: str, test: Column) -> Column:
        return F.when(test, F.col(f"{c}.value")).alias(c)

    return parts.where(first.isNotNull() & (F.col("status.value") != "forgotten")).select(
        "file_name",
        F.col("ingested_at.value").alias("ingested_at"),
        F.coalesce("record_count.value", F.lit(0)).alias("record_count"),
        since("last_timestamp", F.col("last_timestamp.seq") > first),
        F.col("status.value").alias("status"),
        since("error_message", F.col("error_message.seq") > first),
        since("dataset_type", F.col("dataset_type.seq") >= first),
    )


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """The numbers up to which snapshots of the event table hold everything, ascending; a folder without its mark does not count."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path.rstrip('/')}_snapshots")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath() for s in fs.listStatus(folder)]
    return sorted(int(p.getName().removeprefix("upto=")) for p in names if p.getName().startswith("upto=") and fs.exists(hadoop.Path(p, "_SUCCESS")))


def compact(spark: SparkSession, path: str) -> int:
    """Fold all events so far into a snapshot, and return the number up to which it holds them. Later reads take the snapshot and
    newer events. One writer at a time, as for the events."""
    upto = next_seq(spark, path) - 1
    known = snapshots(spark, path)
    if upto > (known[-1] if known else 0):
        parts = _parts(spark, path).where(F.col("seq") <= upto)
        parts.write.mode("overwrite").parquet(f"{path.rstrip('/')}_snapshots/upto={upto}")
    return upto


def drop_folded(spark: SparkSession, path: str) -> int:
    """Remove the event files that the newest snapshot holds whole, and older snapshots; return the number of files removed."""
    known = snapshots(spark, path)
    if not known:
        return 0
    hadoop = spark._jvm.org.apache.hadoop.fs
    held = read_events(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max("seq").alias("last")).where(F.col("last") <= known[-1])
    files = [r["file"] for r in held.select("file").collect()]  # one per append since the snapshot before
    for name in [*files, *(f"{path.rstrip('/')}_snapshots/upto={n}" for n in known[:-1])]:
        old = hadoop.Path(name)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return len(files)


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Partial rows of everything: the newest snapshot and the events after it, whose older files the scan skips by statistics."""
    known = snapshots(spark, path)
    events = read_events(spark, path)
    if not known:
        return partial(events)
    tail = partial(events.where(F.col("seq") > known[-1]))
    held = spark.read.schema(tail.schema).parquet(f"{path.rstrip('/')}_snapshots/upto={known[-1]}")
    return merged(held.unionByName(tail))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The current state of the ledger under a path, from its newest snapshot and what came after."""
    return current(_parts(spark, path))


def bronze_events(files: DataFrame, seq: Column, at: Column | None = None) -> DataFrame:
    """Start and complete events for loaded files (file_name, record_count, dataset_type); the last time stays
    unknown until gold."""
    started = event(files, "start", seq, at, F.col("record_count"), dataset_type=F.col("dataset_type"))
    ended = event(files, "complete", seq + F.lit(1), at, F.col("record_count"), dataset_type=F.col("dataset_type"))
    return started.unionByName(ended)


def gold_events(stats: DataFrame, seq: Column, at: Column | None = None) -> DataFrame:
    """L4: completion after the load, from `file_load_stats`."""
    files = stats.withColumnRenamed("source_file", "file_name")
    return event(files, "gold_complete", seq, at, F.col("record_count"), F.col("last_timestamp"))


def next_seq(spark: SparkSession, path: str) -> int:
    """Above every sequence number so far, also after a stream's checkpoint was lost. One writer at a time: two that ask at
    once get the same number."""
    known = snapshots(spark, path)
    newest = read_events(spark, path).agg(F.max("seq")).first()[0] or 0
    return 1 + max(newest, known[-1] if known else 0)


def forget(spark: SparkSession, names: list[str], path: str) -> None:
    """Let files be loaded again, whatever their state."""
    files = spark.createDataFrame([(n,) for n in names], "file_name string")
    append_events(event(files, "forget", F.lit(next_seq(spark, path))), path)


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table, empty before the first append."""
    try:
        return spark.read.schema(EVENT_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVENT_SCHEMA)


def last_ingested(ledger: DataFrame, n: int = 5) -> DataFrame:
    """T2."""
    return newest_rows(ledger, "ingested_at", n, tie="file_name")
