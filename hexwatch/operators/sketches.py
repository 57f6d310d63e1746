"""Distinct counts over loads (A4, A1): sketches kept per file and load, merged when read.

A theta sketch keeps the least hashes of the values it saw. Sketches of any files merge to that of their union, and intersect, without
their rows. Up to `2 ** LG_ENTRIES` values the result is exact; above, one standard error is `ERROR` of the union. A load adds
its own sketches, a corrected file's newer ones replace its older ones, and no earlier rows are read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.sources import gold as loads

#: 4,096 hashes a sketch, 32 KB at most.
LG_ENTRIES = 12
#: One standard error of a merged count, as a share of the union.
ERROR = 2.0 ** (-LG_ENTRIES / 2)
KEYS = ["source_file", "dataset_type", "load_id"]
SCHEMA = "source_file string, dataset_type string, load_id bigint, crime_count bigint, cells binary, cell_hours binary"


def _sketched(rows: DataFrame) -> DataFrame:
    hour = F.concat_ws("@", "h3_index", F.unix_seconds(F.date_trunc("hour", "occurred_at")))
    return rows.groupBy(*KEYS).agg(
        F.count("*").alias("crime_count"),
        F.theta_sketch_agg("h3_index", LG_ENTRIES).alias("cells"),
        F.theta_sketch_agg(hour, LG_ENTRIES).alias("cell_hours"),
    )


def update(spark: SparkSession, gold_path: str, path: str) -> None:
    """Sketch the loads of the stored table that the sketches do not hold yet. Only their rows are read: the load is a partition.

    A load's sketches are one write, so one that was cut off leaves nothing behind.
    """
    live = loads.live_loads(spark, gold_path).select("load_id").distinct()
    done = _stored(spark, path).select("load_id").distinct()
    todo = [r["load_id"] for r in live.join(done, "load_id", "left_anti").collect()]  # one number per new load
    if not todo:
        return
    rows = spark.read.schema(loads.STORED_SCHEMA).parquet(f"{gold_path}/rows").where(F.col("load_id").isin(todo) & ~F.col("refused"))
    fresh = _sketched(rows)
    # Loads without rows are remembered too.
    marks = spark.createDataFrame([(n,) for n in todo], "load_id bigint")
    fresh.unionByName(marks, allowMissingColumns=True).write.mode("append").parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return loads.read_or_empty(spark, path, SCHEMA)


def current(spark: SparkSession, gold_path: str, path: str) -> DataFrame:
    """One row per file, dataset and load that counts."""
    live = loads.live_loads(spark, gold_path)
    if live.count() <= loads.MAX_BROADCAST_ENTRIES:
        live = F.broadcast(live)
    return _stored(spark, path).join(live, ["source_file", "load_id"], "left_semi")


def distinct_counts(sketches: DataFrame, *keys: str) -> DataFrame:
    """Rows exactly, distinct cells and cell-hours by merged sketches, per value of `keys` or over all."""
    return sketches.groupBy(*keys).agg(
        F.coalesce(F.sum("crime_count"), F.lit(0)).alias("crime_count"),
        F.coalesce(F.theta_sketch_estimate(F.theta_union_agg("cells", LG_ENTRIES)), F.lit(0)).alias("distinct_cells"),
        F.coalesce(F.theta_sketch_estimate(F.theta_union_agg("cell_hours", LG_ENTRIES)), F.lit(0)).alias("distinct_cell_hours"),
    )


def shared_cells(sketches: DataFrame, left: str, right: str, key: str = "dataset_type") -> DataFrame:
    """Cells that two datasets have in common and in all, from their merged sketches alone; no rows of one of them give 0 in common."""
    of = {side: F.theta_union_agg(F.when(F.col(key) == name, F.col("cells")), LG_ENTRIES) for side, name in (("l", left), ("r", right))}
    both = sketches.where(F.col(key).isin(left, right)).agg(*(sketch.alias(side) for side, sketch in of.items()))
    return both.select(
        F.theta_sketch_estimate(F.theta_intersection("l", "r")).alias("shared_cells"),
        F.theta_sketch_estimate(F.theta_union("l", "r", LG_ENTRIES)).alias("all_cells"),
    ).na.fill(0)
