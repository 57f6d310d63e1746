"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles (operator 10).

Equal texts are one text from the start. A text is a weighted set of five-word shingles (of all its words, if it has fewer):
weight (1 + ln tf) * (1 + s * ln(N / max(df, 8)) / ln N) over all N distinct texts; a small s keeps copies in
large groups together, whose shingles have a high df. Steps:

1. Shingle hashes are dealt by hash range as sorted, delta-coded arrays; each range counts its document frequencies. Only
   shingles of two texts or more go back to their texts; the others cannot be shared, so a text needs only their sum.
2. A text whose shared shingles weigh less than the threshold's part of its total cannot reach it with any other text and is
   settled. This follows from the measure and loses nothing.
3. The rest are sampled. A sample is the shingle with the least a = c / (y e^r) and its level; a is Exp(weight)
   distributed, so the private shingles take part as one draw of Exp(their sum), which no other text can match.
4. Samples form bands. In every bucket the member with the most frequent shingles leads, and members that can reach it are
   verified against it by weighted Jaccard. Members that fail go on if private weights and sizes allow any link in the bucket: they
   are verified against the leader's linked members, where their weights and what each has in common with the leader
   allow a link, and meet each other in another round under a new leader. What is left after the last round is compared
   pair by pair, under the same bounds. All bounds are exact, so no link is lost.
5. Components of verified links are the classes; the least doc_id of a class is its id.

With 20 bands of 4 samples a pair at the threshold of 0.8 is missed with probability 3e-5. Hash widths grow with the corpus:
20 bits more than needed to number all shingles. Words are runs of letters and digits in lower case.

Input that is not a stored table should be stored first, so that lost tasks see the same rows again. Defined results: null
and empty texts are one group of equal texts; so are texts without a word only if they are equal; rows with equal doc_id
are judged by their texts; a class with only null ids has a null class id; an empty table yields no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexwatch.llm.common import SpanHash, blocks, column, fresh, mix, small, spans_in, stored, text_array, text_bytes

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
IDF_STRENGTH = 0.1
#: Shingles of up to so many texts are equally rare: in small groups the similarity is that of the plain sets.
RARE = 8
ROUNDS = 3
BUCKET_BYTES = 8 << 20
BLOCK = 1 << 20
FLUSH = 1_000_000
#: Broadcast rows to drop only up to so many (about 40 bytes each).
MAX_BROADCAST_ROWS = 200_000
#: Broadcast the shared shingles of all candidate texts only up to this size.
MAX_BROADCAST_BYTES = 24 << 20

WORD_CLASS = np.zeros(256, bool)
WORD_CLASS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

BLOBS = "batch long, bucket long, hashes binary, docs binary, tfs binary"
SHARED = "tid binary, total double, shared double, typical double, hashes binary, weights binary, bands array<long>"


def text_id(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and the text of each."""
    start, end = spans_in(WORD_CLASS[data], bounds)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Words are hashed alone and combined, so what lies between them does not count.
    words = mix(SpanHash(data)(start, end) + (end - start).astype(np.uint64))
    doc = np.searchsorted(bounds, start, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(bounds) - 1))
    n = np.diff(np.append(first, len(doc)))
    out, base = np.zeros(len(words), np.uint64), np.arange(len(words))
    left = (first + n)[doc] - base  # words from here to the end of the text
    for k in range(WORDS):
        reach = left > k
        at = np.minimum(base + k, len(words) - 1)
        out = np.where(reach, mix(out * np.uint64(0x100000001B3) + words[at]), out)
    whole = left >= WORDS
    short = (n[doc] < WORDS) & (base == first[doc])
    use = whole | short
    return out[use], doc[use]


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted hashes as differences: 4 bytes each if all fit, else 8."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0))
    small = len(gaps) < 2 or int(gaps[1:].max()) < 1 << 32
    head = np.array([int(small), int(values[0])], "<u8").tobytes()
    return head + gaps[1:].astype("<u4" if small else "<u8").tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    small, first = (int(x) for x in np.frombuffer(raw, "<u8", 2))
    gaps = np.frombuffer(raw, "<u4" if small else "<u8", offset=16).astype(np.uint64)
    return np.cumsum(np.concatenate((np.array([first], np.uint64), gaps)), dtype=np.uint64)


def tf_weight(tf: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(tf)


def idf_weight(df: np.ndarray | float, n_texts: int, strength: float) -> np.ndarray:
    return 1.0 + strength * np.log(np.maximum(1.0, n_texts / np.maximum(np.asarray(df, np.float64), RARE))) / math.log(max(n_texts, 2))


def dealt(texts: DataFrame, buckets: int, bits: int) -> DataFrame:
    """Blobs of (bucket, sorted shingle hashes, text in the batch, tf where over 1) for batches of texts.

    For each batch a row with a negative bucket names its texts (16 bytes each) and their total tf weights.
    """
    drop, most = np.uint64(64 - bits), min(FLUSH, max(200_000, 1000 * buckets))
    edges = [(i << bits) // buckets for i in range(1, buckets)]

    def flush(batch: int, ids: list[bytes], parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
        d = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(h)))
        h, d = h[at], d[at]
        totals = np.bincount(d, tf_weight(tf), len(ids))
        cuts = [0, *np.searchsorted(h, np.array(edges, np.uint64)).tolist(), len(h)]
        rows: list[tuple] = [(batch, -1 - batch % buckets, totals.astype("<f8").tobytes(), b"".join(ids), b"")]
        for k in range(buckets):
            i, j = cuts[k], cuts[k + 1]
            if j > i:
                many = np.flatnonzero(tf[i:j] > 1)
                rows.append((batch, k, pack_sorted(h[i:j]), d[i:j].astype("<u2").tobytes(), np.stack((many, tf[i:j][many])).astype("<u4").tobytes()))
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["batch", "bucket", "hashes", "docs", "tfs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            data, bounds = text_bytes(pc.utf8_lower(text_array(batch.column(1))))
            for i, j in blocks(bounds, BLOCK):
                for a in range(i, j, 30_000):
                    b = min(j, a + 30_000)
                    own = bounds[a : b + 1]
                    h, d = shingles(data[own[0] : own[-1]], own - own[0])
                    parts.append((h >> drop, d + len(ids)))
                    ids += keys[a:b]
                    held += len(h)
                    if held >= most or len(ids) >= 30_000:
                        yield flush((task << 32) + made, ids, parts)
                        ids, parts, held, made = [], [], 0, made + 1
        if ids:
            yield flush((task << 32) + made, ids, parts)

    return texts.select("tid", "text").mapInArrow(run, BLOBS)


def counted(blobs: DataFrame) -> DataFrame:
    """Per batch and bucket the shingles of two texts or more: tfs then holds tf and df of each."""

    def run(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() < 0:
            return group
        hashes = [unpack_sorted(x.as_py()) for x in group.column("hashes")]
        every = np.concatenate(hashes)
        _, inverse, n = np.unique(every, return_inverse=True, return_counts=True)
        df = n[inverse]
        rows, at = [], 0
        for k, h in enumerate(hashes):
            own = df[at : at + len(h)]
            at += len(h)
            keep = own > 1
            if keep.any():
                tf = np.ones(len(h), np.int64)
                where, more = np.frombuffer(group.column("tfs")[k].as_py(), "<u4").reshape(2, -1)
                tf[where] = more
                docs = np.frombuffer(group.column("docs")[k].as_py(), "<u2")[keep]
                rows.append((group.column("batch")[k].as_py(), group.column("bucket")[k].as_py(), pack_sorted(h[keep]), docs.tobytes(), np.stack((tf[keep], own[keep])).astype("<u4").tobytes()))
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        columns = list(zip(*rows)) or [[]] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["batch", "bucket", "hashes", "docs", "tfs"])

    return blobs.groupBy("bucket").applyInArrow(run, BLOBS)


def uniforms(seed: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Five values in (0, 1) for every seed and sample number."""
    a = mix(seed + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    b = mix(a ^ np.uint64(0xD1B54A32D192ED03))
    low, shift = np.uint64((1 << 24) - 1), np.uint64(24)
    scale = 2.0**-24
    parts = (a & low, (a >> shift) & low, b & low, (b >> shift) & low, ((a >> np.uint64(48)) << np.uint64(8)) ^ (b >> np.uint64(48)))
    return tuple((p.astype(np.float64) + 0.5) * scale for p in parts)


def samples(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, private: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """n consistent weighted samples of each text as 64-bit values, one row per text.

    starts: where each text's shingles begin (none is empty); private: weight of its unshared shingles; own: its seed.
    """
    out = np.zeros((len(starts), n), np.uint64)
    log_w = np.log(weights)
    sizes = np.diff(np.append(starts, len(hashes)))
    order = np.arange(len(hashes))
    for k in range(n):
        u1, u2, u3, u4, beta = uniforms(hashes, k)
        r = -np.log(u1 * u2)
        level = np.floor(log_w / r + beta)
        value = np.log(-np.log(u3 * u4)) - r * (level - beta) - r
        least = np.minimum.reduceat(value, starts)
        hit = np.where(value == np.repeat(least, sizes), order, len(order))
        best = np.minimum.reduceat(hit, starts)
        got = mix(hashes[best] ^ mix((level[best].astype(np.int64) + (1 << 20)).astype(np.uint64)))
        lone = np.log(np.maximum(-np.log(uniforms(own, k)[0]), 1e-300)) - np.log(np.maximum(private, 1e-300))
        alone = (private > 0) & (lone < least)
        out[:, k] = np.where(alone, mix(own + np.uint64(k)), got)
    return out


def bands_of(sampled: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(sampled), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sampled), b, np.uint64)
        for r in range(rows):
            key = mix(key * np.uint64(0x100000001B3) + sampled[:, b * rows + r])
        keys[:, b] = key
    return keys


def signed(back: DataFrame, n_texts: int, similarity: float, bands: int, rows: int, strength: float) -> DataFrame:
    """Texts that can still have a near duplicate: weights of their shared shingles and their band keys."""
    names = ["tid", "total", "shared", "typical", "hashes", "weights", "bands"]
    types = (pa.binary(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))

    def run(group: pa.Table) -> pa.Table:
        ids, totals, parts = [], np.zeros(0), []
        for row in group.to_pylist():
            if row["bucket"] < 0:
                ids = [row["docs"][i : i + 16] for i in range(0, len(row["docs"]), 16)]
                totals = np.frombuffer(row["hashes"], "<f8")
            else:
                tf, df = np.frombuffer(row["tfs"], "<u4").reshape(2, -1)
                parts.append((unpack_sorted(row["hashes"]), np.frombuffer(row["docs"], "<u2").astype(np.int64), tf, df))
        if not parts:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        h, d, tf, df = (np.concatenate(x) for x in zip(*parts))
        w = tf_weight(tf) * idf_weight(df, n_texts, strength)
        shared = np.bincount(d, w, len(ids))
        private = (totals - np.bincount(d, tf_weight(tf), len(ids))) * idf_weight(1.0, n_texts, strength)
        private[private < 1e-9] = 0.0
        whole = shared + private
        typical = np.bincount(d, w * np.log(df), len(ids)) / np.maximum(whole, 1e-300)
        able = (shared > 0) & (shared >= similarity * whole * (1 - 1e-9))
        keep = able[d]
        order = np.lexsort((h[keep], d[keep]))
        h, d, w = h[keep][order], d[keep][order], w[keep][order]
        texts = np.flatnonzero(able)
        starts = np.searchsorted(d, texts)
        ends = np.append(starts[1:], len(d))
        keys = np.zeros((len(texts), bands), np.uint64)
        own = np.array([int.from_bytes(ids[t][:8], "little") for t in texts], np.uint64)
        i = 0
        while i < len(texts):  # a bounded number of shingles at once
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + 400_000, side="right")))
            s = slice(starts[i], ends[j - 1])
            keys[i:j] = bands_of(samples(h[s], w[s], starts[i:j] - starts[i], private[texts[i:j]], own[i:j], bands * rows), bands, rows)
            i = j
        columns = (
            [ids[t] for t in texts], whole[texts], shared[texts], typical[texts],
            [h[a:b].astype("<u8").tobytes() for a, b in zip(starts, ends)], [w[a:b].astype("<f8").tobytes() for a, b in zip(starts, ends)],
            list(keys.astype(np.int64)),
        )
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return back.groupBy("batch").applyInArrow(run, SHARED)


def weighted_jaccard(a: tuple[bytes, bytes, float], b: tuple[bytes, bytes, float]) -> float:
    """Similarity of two texts from hashes and weights of their shared shingles and their total weights."""
    ha, hb = np.frombuffer(a[0], "<u8"), np.frombuffer(b[0], "<u8")
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    both = float(np.minimum(np.frombuffer(a[1], "<f8")[i], np.frombuffer(b[1], "<f8")[j]).sum())
    union = a[2] + b[2] - both
    return both / union if union > 0 else 0.0


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) pairs with their weighted Jaccard similarity."""
    light = texts.agg(F.sum(F.octet_length("hashes") + F.octet_length("weights"))).first()[0] or 0

    def side(x: str) -> DataFrame:
        rows = texts.select(F.col("tid").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("hashes", "weights", "total")))
        return F.broadcast(rows) if light <= MAX_BROADCAST_BYTES else rows

    loaded = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            values = [
                weighted_jaccard(tuple(col[f"{c}_a"][i].as_py() for c in ("hashes", "weights", "total")), tuple(col[f"{c}_b"][i].as_py() for c in ("hashes", "weights", "total")))
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([col["a"], col["b"], pa.array(values, pa.float64())], names=["a", "b", "similarity"])

    return stored(loaded.mapInArrow(run, "a binary, b binary, similarity double"), "checked")


def components(links: DataFrame) -> DataFrame:
    """(tid, root) of all texts in links (a, b): the least text id of each connected component.

    Labels spread along links and then jump to their label's label, so the rounds grow with the logarithm of a path.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("tid"), F.least("a", "least").alias("root"))
    while True:
        labels = stored(labels.select("tid", "root"), "labels")
        other = small(labels.select(F.col("tid").alias("b"), F.col("root").alias("near")))
        own = small(labels.select(F.col("tid").alias("a"), "root"))
        near = both.join(other, "b").groupBy("a").agg(F.min("near").alias("near"))
        spread = near.join(own, "a").select(F.col("a").alias("tid"), F.col("root").alias("was"), F.least("root", "near").alias("root"))
        up = small(labels.select(F.col("tid").alias("up"), F.col("root").alias("up_root")))
        jumped = stored(spread.join(up, spread["root"] == up["up"]).select("tid", "was", F.least("root", "up_root").alias("root")), "labels")
        if jumped.where("root <> was").isEmpty():
            return labels
        labels = jumped


def reachable(w1: str, s1: str, w2: str, s2: str, similarity: float) -> Column:
    """Whether two texts of these total and shared weights can reach the similarity: they have at most the lesser shared
    weight in common, and at least the rest of both apart."""
    common = F.least(s1, s2)
    return common >= similarity * (1 - 1e-9) * (F.col(w1) + F.col(w2) - common)


def linked_texts(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame | None:
    """Links (a, b) between stored, signed texts that join all pairs in shared buckets that reach the similarity."""
    far = 1.0 - similarity
    members = texts.select("tid", F.col("total").alias("w"), F.col("shared").alias("s"), "typical", F.explode("bands").alias("key"))
    links = None

    def add(pairs: DataFrame) -> None:
        nonlocal links
        links = pairs.select("a", "b") if links is None else links.union(pairs.select("a", "b"))

    for _ in range(ROUNDS):
        # The leader has the most frequent shingles: usually it is the text that the others derive from.
        top = members.groupBy("key").agg(F.max(F.struct("typical", "tid", "w", "s")).alias("top"), F.min("w").alias("low"), F.count("*").alias("n"))
        leaders = stored(top.where("n > 1").select("key", "low", F.col("top.tid").alias("a"), F.col("top.w").alias("wa"), F.col("top.s").alias("sa")), "leaders")
        led = stored(members.join(small(leaders), "key").where("tid <> a"), "led")
        pairs = led.where(reachable("w", "s", "wa", "sa", similarity)).select("a", F.col("tid").alias("b")).distinct()
        checked = verified(pairs, texts)
        add(checked.where(F.col("similarity") >= similarity))
        known = led.join(small(checked.withColumnRenamed("a", "ca")), (F.col("a") == F.col("ca")) & (F.col("tid") == F.col("b")), "left")
        # What a member has in common with the leader follows from their similarity.
        known = known.withColumn("far", 1 - F.col("similarity")).withColumn("i", F.col("similarity") * (F.col("w") + F.col("wa")) / (1 + F.col("similarity")))
        # A member goes on if it can reach the lightest other text of its bucket that could be of its size.
        lightest = F.greatest("low", similarity * F.col("w"))
        open_rows = known.where(F.coalesce(F.col("far") > far, F.lit(True)) & (F.col("s") >= similarity * (1 - 1e-9) * (F.col("w") + lightest - F.col("s"))))
        outer = stored(open_rows.select("key", "tid", "w", "s", "typical", "far", "i"), "outer")
        if outer.isEmpty():
            return links
        inner = known.where(F.col("far") <= far).select("key", F.col("tid").alias("x"), F.col("w").alias("wx"), F.col("s").alias("sx"), F.col("i").alias("ix"))
        # Two members share at most the lesser part of what they have of the leader, and the lesser of their other shared parts.
        parts = F.least("i", "ix") + F.least(F.col("s") - F.col("i"), F.col("sx") - F.col("ix"))
        near = F.coalesce(parts >= similarity * (1 - 1e-9) * (F.col("w") + F.col("wx") - parts), F.lit(True))
        more = inner.join(small(outer), "key").where(reachable("w", "s", "wx", "sx", similarity) & near).select(F.col("x").alias("a"), F.col("tid").alias("b")).distinct()
        add(verified(more, texts).where(F.col("similarity") >= similarity))
        members = outer.select("key", "tid", "w", "s", "typical")
    other = members.select("key", F.col("tid").alias("x"), F.col("w").alias("wx"), F.col("s").alias("sx"))
    rest = members.join(other, "key").where((F.col("x") < F.col("tid")) & reachable("w", "s", "wx", "sx", similarity)).select(F.col("x").alias("a"), F.col("tid").alias("b")).distinct()
    add(verified(rest, texts).where(F.col("similarity") >= similarity))
    return links


def signatures(docs: DataFrame, keys: DataFrame, text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, strength: float = IDF_STRENGTH) -> DataFrame:
    """Stored signatures of the distinct texts that may have near duplicates; `keys` are the documents' stored (tid, size)."""
    found = keys.agg(F.sum("size").alias("size"), F.count_distinct("tid").alias("n")).first()
    size, n_texts = found["size"] or 0, max(1, found["n"])
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    bits = min(64, max(32, math.ceil(math.log2(size + 2)) + 20))
    texts = docs.select(text_id(column(docs, text)).alias("tid"), F.coalesce(column(docs, text), F.lit("")).alias("text")).dropDuplicates(["tid"])
    back = counted(dealt(texts, buckets, bits))
    return stored(signed(back, n_texts, similarity, bands, rows, strength), "signatures")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> tuple[DataFrame, DataFrame]:
    """Stored (doc_id, tid, size) of every document, and (tid, root) of the texts with a near duplicate."""
    t = column(docs, text)
    keys = stored(docs.select(column(docs, doc_id).alias("doc_id"), text_id(t).alias("tid"), F.coalesce(F.octet_length(t), F.lit(0)).cast("long").alias("size")), "keys")
    links = linked_texts(signatures(docs, keys, text, **options), options.get("similarity", SIMILARITY))
    if links is None:
        return keys, keys.select("tid", F.col("tid").alias("root")).limit(0)
    return keys, small(components(links))


def class_of_documents(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id and class_id, the least doc_id of its class (its own if it has no duplicate)."""
    keys, roots = classes(docs, **options)
    per_text = keys.groupBy("tid").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    grouped = per_text.join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    least = grouped.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("n").alias("n")).where("n > 1")
    known = stored(grouped.join(least.drop("n"), "root").select("tid", "class_id"), "classes")
    return keys.join(small(known), "tid", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The input's columns, and of every class exactly one row: one with the least doc_id."""
    keys, roots = classes(docs, text, doc_id, **options)
    rows = keys.groupBy("tid", "doc_id").agg(F.count("*").alias("n")).join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tid")).alias("best"))
    judged = stored(rows.join(best, "root").select("tid", F.col("doc_id").alias("id"), "n", ((F.col("tid") == F.col("best.tid")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))).alias("stays")), "judged")
    losers = judged.where("not stays").select("tid", "id")
    if losers.count() <= MAX_BROADCAST_ROWS:
        losers = F.broadcast(losers)
    tid, id_name = fresh(docs, "tid"), fresh(docs, "row_doc_id")
    named = docs.select(*(column(docs, c) for c in docs.columns), text_id(column(docs, text)).alias(tid), column(docs, doc_id).alias(id_name))
    kept = named.join(losers, (named[tid] == losers["tid"]) & named[id_name].eqNullSafe(losers["id"]), "left_anti")
    if not judged.where("stays and n > 1").isEmpty():
        kept = kept.dropDuplicates([tid])  # repeated rows of one id and text
    return kept.select(*(column(kept, c) for c in docs.columns))
