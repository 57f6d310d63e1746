"""Session settings this package relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes and splits shuffle partitions at run time; all times are UTC. The JVM does not compile
# methods over 8000 bytes: past that size a stage runs faster from split projections than as one generated method.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Batches for Python end at this size as well, not at 10,000 texts of any length: executors hold a batch and its result twice.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Keyed state of any form is kept in this store only.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "hexwatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """The same settings on a session that somebody else built; all of them can change at run time."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise ValueError(f"session time zone must be UTC, is {zone!r}")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder named by `spark.checkpoint.dir`; a local folder only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "hexwatch")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
