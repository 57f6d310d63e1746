"""Document fingerprints of improbable features (operator 6).

Features are windows of 64 bytes. Each window has its Shannon entropy; the rarer an entropy is among all windows of the corpus,
the lower the window's rank. In every run of 64 neighbouring windows the leftmost of least rank gains a vote, and windows with
16 votes or more are selected. They are hashed into Bloom filters of 2048 bits, five bits each, and a filter that holds 160
features is followed by the next. The likeness of two fingerprints is, for each filter of the shorter, the best bit overlap with
a filter of the other, from chance level (plus a margin) at 0 to full overlap at 1, averaged.

Entropies come from running sums: with R equal bytes among the 63 before a byte, adding it to the window changes the sum of
c log c by a table's entry R. All arithmetic is on integers, so equal texts have equal fingerprints everywhere.

Defined results: null and empty texts have no feature and a fingerprint without filters; a text under 64 bytes is one feature;
likeness is 1 for equal fingerprints, and 0 if only one has filters. Rows are ordered by doc_id, null ids last, equal ids by
text; the last row is followed by the first, a lone row by itself.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexwatch.llm.common import SpanHash, blocks, mix, text_array, text_bytes

WINDOW = 64
NEIGHBOURS = 64
VOTES = 16
FILTER_BITS, HASHES, FILTER_FEATURES = 2048, 5, 160
MARGIN = 0.3
LEVELS = 1000
#: Windows of less entropy than this part of the maximum say nothing (runs of one byte, padding).
WEAK = 0.1
SEGMENT = 1 << 16
PART_BYTES = 24 << 20
BLOCK = 1 << 20
NONE = 1023

_C = np.arange(WINDOW + 2)
_SUMS = np.round(np.where(_C > 0, _C * np.log2(np.maximum(_C, 1)), 0) * 65536).astype(np.int64)
GAIN = np.diff(_SUMS)  # by how much c log c grows from c to c + 1


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy of every 64-byte window, in thousandths of the maximum."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for a in range(0, len(data), SEGMENT):  # segments that stay in the cache
        b = min(len(data), a + SEGMENT)
        part = data[a : min(len(data), b + WINDOW - 1)]
        own = b - a
        head, into = after[a:b], before[a : a + len(part)]
        for d in range(1, WINDOW):
            m = min(own, len(part) - d)
            if m <= 0:
                break
            same = (part[:m] == part[d : d + m]).view(np.uint8)
            head[:m] += same
            into[d : d + m] += same
    first = int(_SUMS[np.bincount(data[:WINDOW], minlength=256)].sum())
    change = GAIN[before[WINDOW:]] - GAIN[after[: n - 1]]
    total = np.empty(n, np.int64)
    total[0] = 0
    np.cumsum(change, out=total[1:])
    total += first
    most = int(_SUMS[WINDOW])
    return (most - total) * LEVELS // most


def ranks_of(histogram: np.ndarray) -> np.ndarray:
    """Rank of each entropy level, the rarest first; weak levels have none."""
    ranks = np.full(LEVELS + 1, NONE, np.uint32)
    strong = np.arange(int(LEVELS * WEAK), LEVELS + 1)
    order = strong[np.lexsort((-strong, histogram[strong]))]
    ranks[order] = np.arange(len(order))
    return ranks


def selected(ranks: np.ndarray) -> np.ndarray:
    """Positions with enough votes as the leftmost least rank of their neighbourhoods."""
    n = len(ranks)
    votes = np.zeros(n, np.int32)
    for a in range(-NEIGHBOURS + 1, n, SEGMENT):  # neighbourhoods that begin in [a, a + SEGMENT)
        lo, hi = max(0, a), min(n, a + SEGMENT + NEIGHBOURS - 1)
        key = np.full(min(SEGMENT, n - a) + NEIGHBOURS - 1, NONE << 17, np.uint32)
        key[lo - a : hi - a] = (ranks[lo:hi] << np.uint32(17)) | np.arange(lo - a, hi - a, dtype=np.uint32)
        span = 1
        while span < NEIGHBOURS:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        key = key[key < NONE << 17]
        np.add.at(votes, (key & np.uint32((1 << 17) - 1)).astype(np.int64) + a, 1) if len(key) < 64 else _vote(votes, key, a)
    return np.flatnonzero(votes >= VOTES)


def _vote(votes: np.ndarray, key: np.ndarray, shift: int) -> None:
    counts = np.bincount((key & np.uint32((1 << 17) - 1)).astype(np.int64))
    at = np.flatnonzero(counts)
    votes[at + shift] += counts[at].astype(np.int32)


def filters_of(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Bloom filters (rows of 256 bytes) of each text."""
    gap = NEIGHBOURS + 1
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + gap)))[:-1]
    data = np.frombuffer(bytes(gap).join(texts) + bytes(gap), np.uint8)
    level = entropy_levels(data)
    # A window belongs to a text if it lies in it whole; between two texts are more invalid ones than a neighbourhood holds.
    rank = np.full(len(level), NONE, np.uint32)
    whole = np.zeros(len(level) + 1, np.int8)
    long = sizes >= WINDOW
    np.add.at(whole, starts[long], 1)
    np.add.at(whole, starts[long] + sizes[long] - WINDOW + 1, -1)
    valid = np.cumsum(whole[:-1]) > 0
    rank[valid] = ranks[level[valid]]
    at = selected(rank)
    hashed = SpanHash(data)
    short = starts[(sizes > 0) & ~long]
    begin = np.concatenate((at, short))
    end = np.concatenate((at + WINDOW, short + sizes[(sizes > 0) & ~long]))
    h = mix(hashed(begin, end) + (end - begin).astype(np.uint64))
    doc = np.searchsorted(starts, begin, side="right") - 1
    order = np.lexsort((begin, h, doc))
    h, doc, begin = h[order], doc[order], begin[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc, begin = h[first], doc[first], begin[first]
    order = np.lexsort((begin, doc))
    h, doc = h[order], doc[order]
    count = np.bincount(doc, minlength=len(texts))
    number = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
    held = -(-count // FILTER_FEATURES)
    base = np.cumsum(held) - held
    bits = np.zeros(int(held.sum()) * FILTER_BITS, np.uint8)
    where = (base[doc] + number // FILTER_FEATURES) * FILTER_BITS
    for k in range(HASHES):
        bits[where + ((h >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    packed = np.packbits(bits).reshape(-1, FILTER_BITS // 8)
    return [packed[b : b + n] for b, n in zip(base, held)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two filter chains, 0 to 1."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    x, y = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    nx, ny = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    total = 0.0
    for i in range(len(x)):
        both = np.bitwise_count(x[i] & y).sum(1, dtype=np.int64)
        most = np.minimum(nx[i], ny)
        chance = nx[i] * ny / FILTER_BITS
        floor = chance + MARGIN * (most - chance)
        total += max(0.0, float(((both - floor) / np.maximum(most - floor, 1e-9)).max()))
    return min(1.0, total / len(x))


def shown(filters: np.ndarray) -> str:
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}"


def parsed(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), np.uint8).reshape(-1, FILTER_BITS // 8)


def edited(text: str, other: str) -> str:
    """The text with its last half of code points replaced by as many of the other's first, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def rarity(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Ranks of entropy levels over all windows of all texts, and the texts' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(text_array(batch.column(0)))
            total = np.zeros(LEVELS + 2, np.int64)
            total[-1] = len(data)
            for i, j in blocks(bounds, BLOCK):
                own = bounds[i : j + 1]
                level = entropy_levels(data[own[0] : own[-1]])
                ends = own[1:] - own[0]
                whole = np.ones(len(level), bool)
                for e in ends[:-1]:  # windows that cross the end of a text
                    whole[max(0, e - WINDOW + 1) : e] = False
                total[: LEVELS + 1] += np.bincount(level[whole], minlength=LEVELS + 1)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["level", "n"])

    rows = docs.select(text).mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()  # LEVELS + 2 rows at most
    histogram = np.zeros(LEVELS + 2, np.int64)
    for r in rows:
        histogram[r["level"]] = r["n"]
    return ranks_of(histogram[: LEVELS + 1]), int(histogram[-1])


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """Rows in ranges of doc_id, each range sorted and followed by the first row of the next (`guest`).

    Ranges are found from approximate quantiles. What reaches the driver is a few numbers per range.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    edges = sorted({float(e) for e in rows.where("doc_id is not null").approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.1 / parts)}) if parts > 1 else []
    if edges:
        cut = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="place", outputCol="part", handleInvalid="keep")
        placed = cut.transform(rows.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(math.nan)))).select("doc_id", "text", F.col("part").cast("long").alias("part"))
    else:
        placed = rows.withColumn("part", F.lit(0).cast("long"))
    firsts = sorted(((r["part"], r["first"]) for r in placed.groupBy("part").agg(F.min("doc_id").alias("first")).collect()))
    if not firsts:
        return placed.withColumn("guest", F.lit(False))
    spark = docs.sparkSession
    links = [(firsts[(k + 1) % len(firsts)][1], part) for k, (part, _) in enumerate(firsts)]
    targets = spark.createDataFrame(links, "first long, part long")
    guests = rows.join(F.broadcast(targets), rows["doc_id"].eqNullSafe(targets["first"])).groupBy("part").agg(F.min("text").alias("text"))  # one row per range
    every = placed.withColumn("guest", F.lit(False)).unionByName(guests.select(F.lit(None).cast("long").alias("doc_id"), "text", "part", F.lit(True).alias("guest")))
    return every.repartition(parts, "part").sortWithinPartitions("part", "guest", F.col("doc_id").asc_nulls_last(), "text")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see the module."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks, size = rarity(docs)
    parts = max(1, math.ceil(size / PART_BYTES))

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        texts = [t.encode() for _, _, _, t in rows]
        pairs = [i for i in range(len(rows) - 1) if not rows[i][2] and rows[i][0] == rows[i + 1][0]]
        changed = [edited(rows[i][3], rows[i + 1][3]).encode() for i in pairs]
        found = filters_of([*texts, *changed], ranks)
        own, new = found[: len(texts)], found[len(texts) :]
        out = [
            (rows[i][1], len(rows[i][3]), hashlib.sha256(changed[k]).hexdigest(), shown(own[i]), shown(new[k]), likeness(own[i], new[k]), likeness(own[i], own[i + 1]))
            for k, i in enumerate(pairs)
        ]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = [c.split()[0] for c in OUT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("part", "doc_id", "guest", "text")]
            for k in range(batch.num_rows):
                held.append(tuple(c[k].as_py() for c in columns))
                size += len(held[-1][3])
                if size >= BLOCK and len(held) > 1:
                    yield emit(held)
                    held, size = held[-1:], 0
        if len(held) > 1:
            yield emit(held)

    return in_order(docs, parts).mapInArrow(run, OUT)
