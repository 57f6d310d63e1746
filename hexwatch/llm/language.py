"""Language ID by bit-sliced Bloom filters (operator 3).

Every language has a Bloom filter of its frequent n-grams. The filters share their hash functions and are stored sliced:
word i holds bit i of all languages, so that one look-up per hash function and an AND give the set of all languages that
contain an n-gram. A text's n-grams are counted per language; the counts are corrected for the filters' false positive
rate, and the largest corrected count decides.

An n-gram is four bytes of the lower-cased UTF-8 text, in which everything but letters is one space.

Defined results: null texts and texts without a letter are `und` with score 0; a text without any known n-gram gets the most
frequent learned language with score 0; ties go to the alphabetically first language; equal texts get equal results. With
nothing to learn from, every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexwatch.llm.common import blocks, column, text_array, text_bytes, with_columns

UNKNOWN = "und"
HASHES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
SAMPLE_DOCS = 3000
MIN_SHARE = 2e-6
MIN_RATIO = 0.05


def _letters() -> np.ndarray:
    keep = np.full(256, 32, np.uint8)
    for b in (*range(97, 123), *range(128, 256)):
        keep[b] = b
    return keep


KEEP = _letters()


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts and how many there are before each text; none crosses a text or holds two spaces in a row."""
    n = int(bounds[-1])
    # One space before and after each text.
    shift = np.arange(len(bounds) - 1) * 2 + 1
    out = np.full(n + 2 * (len(bounds) - 1) + 3, 32, np.uint8)
    where = np.arange(n) + np.repeat(shift, np.diff(bounds))
    out[where] = KEEP[data]
    w = out.astype(np.uint32)
    g = (w[:-3] << np.uint32(24)) | (w[1:-2] << np.uint32(16)) | (w[2:-1] << np.uint32(8)) | w[3:]
    space = out == 32
    double = space[:-1] & space[1:]
    good = ~(double[:-2] | double[1:-1] | double[2:])
    count = np.concatenate(([0], np.cumsum(good)))
    starts = np.append(bounds[:-1] + shift - 1, len(g))
    return g[good], count[np.minimum(starts, len(g))]


class SlicedFilters:
    """Bloom filters of several languages, one bit column each."""

    def __init__(self, languages: list[str], sets: list[np.ndarray], common: str | None):
        self.languages, self.common = languages, common
        largest = max([1, *(len(s) for s in sets)])
        self.bits = max(12, int(np.ceil(np.log2(largest * 16))))
        self.words = np.zeros((max(1, (len(languages) + 63) // 64), 1 << self.bits), np.uint64)
        for k, s in enumerate(sets):
            for h in self._slots(s.astype(np.uint32)):
                np.bitwise_or.at(self.words[k // 64], h, np.uint64(1 << (k % 64)))
        fill = np.array([((self.words[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
        self.false_rate = fill ** len(HASHES)

    def _slots(self, g: np.ndarray) -> list[np.ndarray]:
        g = g ^ (g >> np.uint32(15))
        return [(g * np.uint32(h)) >> np.uint32(32 - self.bits) for h in HASHES]

    def masks(self, g: np.ndarray) -> list[np.ndarray]:
        """The languages of each n-gram as bits, 64 languages to a word."""
        slots = self._slots(g)
        return [w[slots[0]] & w[slots[1]] & w[slots[2]] for w in self.words]

    def counts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts per text and language, and the number of n-grams per text."""
        g, before = grams(data, bounds)
        total = np.diff(before).astype(np.float64)
        found = np.zeros((len(total), len(self.languages)))
        words = self.masks(g)
        for k in range(len(self.languages)):
            hit = (words[k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            found[:, k] = np.diff(np.concatenate(([0], np.cumsum(hit.astype(np.int64))))[before])
        rate = np.minimum(self.false_rate, 0.999)
        return np.maximum(0.0, (found - total[:, None] * rate) / (1 - rate)), total

    def predict(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        names, scores = [], []
        lower = pc.utf8_lower(texts)
        data, bounds = text_bytes(lower)
        for i, j in blocks(bounds):
            own = bounds[i : j + 1]
            if self.languages:
                counts, total = self.counts(data[own[0] : own[-1]], own - own[0])
                best = counts.argmax(1)
                top = counts[np.arange(len(best)), best]
                names += [self.languages[b] if c > 0 else self.common for b, c in zip(best, top)]
                scores.append(np.minimum(1.0, top / np.maximum(total, 1)))
            else:
                names += [UNKNOWN] * (j - i)
                scores.append(np.zeros(j - i))
        score = np.concatenate(scores) if scores else np.zeros(0)
        worded = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(~worded.astype(bool)):
            names[i], score[i] = UNKNOWN, 0.0
        return pa.array(names, pa.string()), pa.array(score)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE_DOCS) -> SlicedFilters:
    """Filters from labelled rows: about `sample` distinct texts per language, chosen by the hash of the text.

    Copies of a text count once, so neither the sample's size nor its mix depends on them. The sample is the documented bound of the fit. An n-gram enters a language's filter if it makes up at least MIN_SHARE
    of the language's n-grams and MIN_RATIO of its largest share in any language. What is sent to the driver is the
    n-gram counts of the sample, whose number is bounded by it.
    """
    rows = labelled.select(column(labelled, text).alias("text"), column(labelled, lang).alias("lang")).where("lang is not null and text is not null")
    texts = rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.count("*").alias("n"))
    found = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()
    sizes, distinct = ({r["lang"]: r[k] for r in found} for k in ("n", "distinct"))
    if not sizes:
        return SlicedFilters([], [], None)
    rates = F.create_map(*(F.lit(x) for k, n in distinct.items() for x in (k, int(min(1.0, sample / n) * 1_000_000))))
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < rates[F.col("lang")]).dropDuplicates(["lang", "text"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1)
            for value in pc.unique(langs).to_pylist():
                texts = pc.utf8_lower(text_array(batch.column(0).filter(pc.equal(langs, value))))
                data, bounds = text_bytes(texts)
                for i, j in blocks(bounds, 8 << 20):
                    own = bounds[i : j + 1]
                    g, _ = grams(data[own[0] : own[-1]], own - own[0])
                    values, n = np.unique(g, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([value] * len(n), pa.string()), pa.array(values.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    langs, gram, n = (counted.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "gram", "n"))
    names = sorted(sizes)
    share = {}
    for name in names:
        at = langs == name
        share[name] = dict(zip(gram[at].tolist(), (n[at] / max(1, n[at].sum())).tolist()))
    top: dict[int, float] = {}
    for shares in share.values():
        for g, s in shares.items():
            top[g] = max(s, top.get(g, 0.0))
    sets = [np.array(sorted(g for g, s in share[name].items() if s >= MIN_SHARE and s >= MIN_RATIO * top[g]), np.int64) for name in names]
    return SlicedFilters(names, sets, max(names, key=lambda k: (sizes[k], k)))


def identify(docs: DataFrame, filters: SlicedFilters, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Every row with its predicted language and the share of its n-grams that this language explains."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # bits * languages: at most a few MB by the learning sample
    return with_columns(docs, text, {into[0]: T.StringType(), into[1]: T.DoubleType()}, lambda texts: shared.value.predict(texts))
