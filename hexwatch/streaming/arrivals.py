"""Incremental bronze to gold over newly arrived files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.operators import aggregates, joins, ledger
from hexwatch.plans import incident
from hexwatch.sources.bronze import PATTERN, SOURCE_FILE, Landing, exact, scan_landing
from hexwatch.sources.gold import scan_gold, write_gold

ARRIVAL_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
FILE_FACTS = "file_name string, record_count bigint, dataset_type string, error_message string"
Scan = Callable[[SparkSession, list[str]], Landing]


def load_files(
    spark: SparkSession, paths: list[str], gold_path: str, ledger_path: str, scan: Scan = scan_landing, key_index: str | None = None,
) -> None:
    """Load files of one batch, whatever the ledger says of them, and record every step.

    Usable files start with their raw row count and dataset type before the load and complete after it, also if none of
    their rows survive; unusable ones start and fail with the reason. If the load as a whole fails, its halves are tried, so that
    one file that cannot be read does not hold back the others. With `key_index` copies of rows of earlier loads are dropped.
    """
    def record(facts: list[dict], *kinds: str) -> None:
        seq = ledger.next_seq(spark, ledger_path)
        rows = spark.createDataFrame([(f["file_name"], f.get("record_count"), f.get("dataset_type"), f.get("reason")) for f in facts], FILE_FACTS)
        made = [ledger.event(rows, k, F.lit(seq + i), record_count=F.col("record_count") if k != "fail" else None, dataset_type=F.col("dataset_type"),
                             error_message=F.col("error_message") if k == "fail" else None) for i, k in enumerate(kinds)]
        events = made[0]
        for e in made[1:]:
            events = events.unionByName(e)
        ledger.append_events(events, ledger_path)

    try:
        landing = scan(spark, [exact(p) for p in paths])
        if landing.unusable:
            record(landing.unusable, "start", "fail")
        if not landing.files:
            return
        facts = _with_counts(landing)
        record(facts, "start")
        names = [f["file_name"] for f in facts]
        write_gold(incident.gold_or_refused(incident.silver(landing.frames, key_index=key_index, files=names)), gold_path, mode="replace", files=names)
        record(facts, "complete")
        stored = scan_gold(spark, gold_path).where(F.col(SOURCE_FILE).isin(names))
        stats = aggregates.file_load_stats(stored).drop("record_count").withColumnRenamed(SOURCE_FILE, "file_name")
        raw_counts = spark.createDataFrame([(f["file_name"], f["record_count"]) for f in facts], "file_name string, record_count bigint")
        done = raw_counts.join(stats, "file_name", "left")
        seq = F.lit(ledger.next_seq(spark, ledger_path))
        ledger.append_events(ledger.event(done, "gold_complete", seq, record_count=F.col("record_count"), last_timestamp=F.col("last_timestamp")), ledger_path)
    except (PySparkException, OSError) as e:
        if len(paths) > 1:
            half = len(paths) // 2
            for part in (paths[:half], paths[half:]):
                load_files(spark, part, gold_path, ledger_path, scan, key_index)
        else:
            record([{"file_name": paths[0].rsplit("/", 1)[-1], "reason": str(e)}], "start", "fail")


def _with_counts(landing: Landing) -> list[dict]:
    """Files with their raw row counts; those with line breaks in cells are counted by reading them."""
    open_names = [f["file_name"] for f in landing.files if f["record_count"] is None]
    if not open_names:
        return landing.files
    counted: dict[str, int] = {}
    for frame in landing.frames:
        rows = frame.where(F.col(SOURCE_FILE).isin(open_names)).groupBy(SOURCE_FILE).agg(F.count("*").alias("n")).collect()
        counted |= {r[SOURCE_FILE]: r["n"] for r in rows}
    return [f | {"record_count": counted.get(f["file_name"], 0) if f["record_count"] is None else f["record_count"]} for f in landing.files]


def load_arrivals(
    spark: SparkSession,
    landing: str,
    gold_path: str,
    ledger_path: str,
    checkpoint: str,
    pattern: str = PATTERN,
    max_files: int = 1000,
    scan: Scan = scan_landing,
    retry_failed: bool = False,
    key_index: str | None = None,
):
    """Start the stream and return its query; it ends when the files present now are loaded.

    The stream carries file names only (the content column is pruned). Each batch loads the files that the ledger does not
    know, or with `retry_failed` has not seen completed. When a batch is repeated after a failure, its files either are in the
    ledger or replace what they had loaded. A corrected file is loaded again by `ledger.forget` and `load_files`.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(ARRIVAL_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        seen = ledger.read_state(session, ledger_path)
        # Started but not completed: a load that was cut off is taken up again.
        open_ones = seen.where("status <> 'in_progress'")
        files = joins.unseen_files(batch, open_ones, retry_failed).select("path").collect()  # at most max_files
        if files:
            load_files(session, [r["path"] for r in files], gold_path, ledger_path, scan, key_index)

    return (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
