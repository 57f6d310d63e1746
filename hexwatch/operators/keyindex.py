"""Keys of earlier loads (W1 across loads): a copy that comes with a later load is dropped, the first load wins.

The index is a folder of loads like the stored table: `rows` holds the keys each load kept with their files, `entries` says which
loads count for a file, `filters` a Bloom filter per load. A filter is a table of blocks, four 64-bit words each; filters of one
level merge by `bit_or`, so new keys meet one row per block instead of all older keys, and only possible hits are compared with
the keys themselves. The result is exact: a filter has no false negatives, and false hits end at the comparison.

A load's level is chosen for all keys the index then holds, so the filters of a level together never hold more keys than one was
made for, and there are as many levels as the number of keys has doublings.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.session import shared_dir
from hexwatch.settings import RAW_KEY
from hexwatch.sources import gold as loads
from hexwatch.sources.bronze import SOURCE_FILE

ROWS_SCHEMA = "key string, source_file string, load_id bigint"
FILTER_SCHEMA = "level int, block bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint"
SIZES_SCHEMA = "load_id bigint, key_rows bigint"
WORDS = ["w0", "w1", "w2", "w3"]
#: A block of 256 bits for so many keys: 16 bits a key, 8 of them set.
KEYS_PER_BLOCK = 16
#: Blocks of 40 bytes; up to so many (64 MB) are broadcast, more are joined by shuffle.
MAX_BROADCAST_BLOCKS = 1_600_000
#: Keys are short; more than so many are joined by shuffle.
MAX_BROADCAST_KEYS = 500_000


def _hash(key: Column) -> Column:
    """Missing keys are one key."""
    return F.xxhash64(F.coalesce(key, F.lit("")), key.isNull())


def _block(h: Column, level: int) -> Column:
    """The block of a level with `2 ** level` of them, from other bits than those set in it."""
    return F.xxhash64(h).bitwiseAND(F.lit((1 << level) - 1).cast("bigint"))


def _bits(h: Column) -> list[Column]:
    """Two bits in each of the four words, twelve hash bits a word."""
    out = []
    for i in range(4):
        at = F.shiftrightunsigned(h, 12 * i).bitwiseAND(F.lit(4095))
        one = F.lit(1).cast("bigint")
        # The functions take numbers of places as columns only through SQL.
        low = F.call_function("shiftleft", one, at.bitwiseAND(F.lit(63)).cast("int"))
        high = F.call_function("shiftleft", one, F.shiftright(at, 6).cast("int"))
        out.append(low.bitwiseOR(high))
    return out


def level_for(keys: int) -> int:
    """Doublings of blocks so that `keys` keys fill them at most as planned."""
    return max(0, (max(keys, 1) - 1) // KEYS_PER_BLOCK).bit_length()


def add_keys(rows: DataFrame, path: str, files: list[str], key: str = RAW_KEY) -> None:
    """Store the keys of a load; they replace what the index held of `files`, also by none.

    One row per (key, file) is stored. The load counts when its entries are written, after keys and filter, so a load that was cut
    off half-way leaves bits behind but no keys.
    """
    spark = rows.sparkSession
    load_id = max(time.time_ns(), 1 + (loads.entries_of(spark, path).agg(F.max("load_id")).first()[0] or 0))
    found = rows.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(SOURCE_FILE)).distinct()
    found.withColumn("load_id", F.lit(load_id)).write.mode("append").partitionBy("load_id").parquet(f"{path}/rows")
    stored = spark.read.schema(ROWS_SCHEMA).parquet(f"{path}/rows").where(F.col("load_id") == load_id)
    added = stored.count()
    before = loads.read_or_empty(spark, f"{path}/sizes", SIZES_SCHEMA).agg(F.sum("key_rows")).first()[0] or 0
    level = level_for(before + added)
    h = _hash(F.col("key"))
    hashed = stored.select(h.alias("h")).select(_block(F.col("h"), level).alias("block"), *(b.alias(w) for b, w in zip(_bits(F.col("h")), WORDS)))
    blocks = hashed.groupBy("block").agg(*(F.bit_or(w).alias(w) for w in WORDS))
    blocks.select(F.lit(level).alias("level"), "block", *WORDS).write.mode("append").parquet(f"{path}/filters")
    spark.createDataFrame([(load_id, added)], SIZES_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/sizes")
    names = spark.createDataFrame([(f,) for f in files], "source_file string")
    entries = stored.select("source_file").union(names).distinct()
    loads.publish(entries.select("source_file", F.lit(load_id).alias("load_id"), F.lit(True).alias("replaces")), path)


def merged_filters(spark: SparkSession, path: str) -> DataFrame:
    """One row per level and block over all loads."""
    return loads.read_or_empty(spark, f"{path}/filters", FILTER_SCHEMA).groupBy("level", "block").agg(*(F.bit_or(w).alias(w) for w in WORDS))


def possible_hits(keys: DataFrame, path: str) -> DataFrame:
    """Of distinct keys (column `key`), those that some filter holds; false ones are among them, no true one is missing."""
    spark = keys.sparkSession
    filters = merged_filters(spark, path)
    levels = [r[0] for r in filters.select("level").distinct().collect()]  # at most one per doubling
    if not levels:
        return keys.limit(0)
    if filters.count() <= MAX_BROADCAST_BLOCKS:
        filters = F.broadcast(filters)
    mine = [f"m{i}" for i in range(4)]
    hashed = keys.select("key", _hash(F.col("key")).alias("h"))
    places = F.array(*(F.struct(F.lit(n).alias("level"), _block(F.col("h"), n).alias("block")) for n in sorted(levels)))
    probes = hashed.select("key", *(b.alias(m) for b, m in zip(_bits(F.col("h")), mine)), F.inline(places))
    held = F.lit(True)
    for m, w in zip(mine, WORDS):
        held = held & (F.col(m).bitwiseAND(F.col(w)) == F.col(m))
    return probes.join(filters, ["level", "block"]).where(held).select("key").distinct()


def known_keys(keys: DataFrame, path: str, files: list[str]) -> DataFrame:
    """Of distinct keys, those that a file outside `files` holds in a load that counts. Exact.

    The possible hits are written first: otherwise the comparison with the older keys would be planned ahead of the filters, for all new
    keys. Older keys are read as one column and are not shuffled while the hits are few.
    """
    spark = keys.sparkSession
    held = shared_dir(spark, "possible-hits")
    possible_hits(keys, path).write.parquet(held)
    hits = spark.read.schema("key string").parquet(held)
    live = loads.live_loads(spark, path)
    if live.count() <= loads.MAX_BROADCAST_ENTRIES:
        live = F.broadcast(live)
    others = F.broadcast(spark.createDataFrame([(f,) for f in files], "source_file string"))  # the files of one load
    stored = loads.read_or_empty(spark, f"{path}/rows", ROWS_SCHEMA).join(live, ["source_file", "load_id"], "left_semi")
    stored = stored.join(others, "source_file", "left_anti").select(F.col("key").alias("old"))
    if hits.count() <= MAX_BROADCAST_KEYS:
        return stored.join(F.broadcast(hits), F.col("old").eqNullSafe(F.col("key"))).select("key").distinct()
    return hits.join(stored, F.col("key").eqNullSafe(F.col("old")), "left_semi")


def drop_known(rows: DataFrame, path: str, files: list[str], key: str = RAW_KEY) -> DataFrame:
    """Rows whose key no earlier load of another file holds. `files` are those of this load: what they held before does not
    count, since they are replaced. A key that its first file no longer holds after a correction is free for later loads; copies of it
    that were dropped before come back when their file is loaded again."""
    mine = F.col(f"`{key}`").cast("string")
    known = known_keys(rows.select(mine.alias("key")).distinct(), path, files)
    known_at = shared_dir(rows.sparkSession, "known-keys")
    known.select(F.col("key").alias("known_key")).write.parquet(known_at)
    known = rows.sparkSession.read.schema("known_key string").parquet(known_at)
    if known.count() <= MAX_BROADCAST_KEYS:
        known = F.broadcast(known)
    return rows.join(known, mine.eqNullSafe(F.col("known_key")), "left_anti")
