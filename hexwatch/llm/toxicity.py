"""Counterfactual-regularised toxicity classifier (operator 2).

A logistic model over hashed words and word beginnings is fitted on a bounded sample of labelled texts. Of every sentence of the
sample there are counterfactuals: where a sentence names an identity group, the term is swapped for each other term of the same
kind; where it names none, each term of a kind is put in the place of an ordinary word, one without a feature of the model.
The squared change of the score is added to the loss. Terms that only name a group then carry no weight of their own, nor by
beginnings that they share with other words, so neutral mentions are not scored as toxic. Counterfactuals that differ in the same
features are one pair with a weight; those that differ in none change nothing, and are only counted. Only features that are
common enough in the sample and tell the labels apart are kept, so a long text does not gather the noise of thousands of rare words.

Defined results: null and empty texts get the score of the intercept; very long texts are scored whole; without labelled rows, or
with labels of one kind only, every score is that share of toxic labels (0 without any); of several labels of one document the
largest counts; ties in the sample are broken by document id; a score equal to the threshold is predicted toxic; equal texts and
repeated rows get equal scores; an empty table yields no rows; columns with the name of a result, in any case, are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexwatch.llm.common import SpanHash, blocks, mix, spans_in, stored, text_array, text_bytes, with_columns

BITS = 22
MAX_POSITIVE, MAX_NEGATIVE = 2500, 6000
MIN_TEXTS = 4
MIN_GAIN = 4.0
COUNTERFACTUAL = 4.0
RIDGE = 0.0002
STEPS = 300
THRESHOLD = 0.3
#: Byte lengths of word beginnings that are features beside the whole word.
PREFIXES = (4, 5, 6, 7, 8, 10)

#: Terms that name groups, by kind; a term is swapped for the others of its kind and language.
IDENTITY_TERMS = {
    ("en", "religion"): "muslim christian jewish hindu buddhist atheist catholic sikh".split(),
    ("en", "origin"): "african american asian european mexican chinese indian arab".split(),
    ("en", "colour"): "black white brown".split(),
    ("en", "gender"): "woman man girl boy".split(),
    ("en", "genders"): "women men girls boys".split(),
    ("en", "orientation"): "gay straight lesbian bisexual transgender heterosexual".split(),
    ("en", "ability"): "deaf blind disabled autistic".split(),
    ("fr", "religion"): "musulman chrétien juif hindou bouddhiste athée catholique".split(),
    ("fr", "origin"): "africain américain asiatique européen chinois indien arabe".split(),
    ("fr", "gender"): "femme homme fille garçon".split(),
    ("de", "religion"): "muslimisch christlich jüdisch hinduistisch buddhistisch atheistisch katholisch".split(),
    ("de", "origin"): "afrikanisch amerikanisch asiatisch europäisch chinesisch indisch arabisch".split(),
    ("de", "gender"): "frau mann mädchen junge".split(),
    ("es", "religion"): "musulmán cristiano judío hindú budista ateo católico".split(),
    ("es", "origin"): "africano americano asiático europeo chino indio árabe".split(),
    ("es", "gender"): "mujer hombre niña niño".split(),
}
SWAPS: dict[str, list[str]] = {}
for _terms in IDENTITY_TERMS.values():
    for _term in _terms:
        SWAPS.setdefault(_term, []).extend(t for t in _terms if t != _term)
TERM = re.compile(r"(?<!\w)(" + "|".join(sorted(map(re.escape, SWAPS), key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)
SENTENCE = re.compile(r"[^.!?\n]+")

WORD_CLASS = np.zeros(256, bool)
WORD_CLASS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature slots and their texts: the words of lower-cased texts, then each length of word beginnings."""
    start, end = spans_in(WORD_CLASS[data], bounds)
    doc = np.searchsorted(bounds, start, side="right") - 1
    hashed = SpanHash(data)
    shift = np.uint64(64 - BITS)
    yield (mix(hashed(start, end) * np.uint64(31)) >> shift).astype(np.int64), doc
    for n in PREFIXES:
        long = end - start > n
        s = start[long]
        yield (mix(hashed(s, s + n) * np.uint64(31) + np.uint64(n)) >> shift).astype(np.int64), doc[long]


def counts_of(data: np.ndarray, bounds: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, count) of all features, or of those whose slot is true in `keep`."""
    keys = []
    for slot, doc in features(data, bounds):
        if keep is not None:
            use = keep[slot]
            slot, doc = slot[use], doc[use]
        keys.append((doc << BITS) | slot)
    key, n = np.unique(np.concatenate(keys), return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), n


def value(n: np.ndarray) -> np.ndarray:
    return np.log1p(n).astype(np.float64)


WORD = re.compile(r"[^\W_]+")
#: Kinds of terms by number, for the choice of one per sentence.
KIND_LIST = list(IDENTITY_TERMS.values())


class Counterfactuals:
    """Pairs of a text's sentences with other terms, by the model's features that only the one or only the other holds."""

    #: Words whose features are remembered.
    most = 1 << 18

    def __init__(self, features_of) -> None:
        """`features_of` gives the model's features of each word of a list."""
        self.features_of = features_of
        self.known: dict[str, frozenset] = {}
        terms = [t for kind in KIND_LIST for t in kind]
        self.learn(terms)
        self.terms = {t: self.known[t] for t in terms}

    def learn(self, words) -> None:
        if new := sorted(set(words) - self.known.keys()):
            if len(self.known) > self.most:
                self.known = dict(self.terms)
                new = sorted(set(words) - self.known.keys())
            self.known.update(zip(new, map(frozenset, self.features_of(new))))

    def of(self, text: str) -> tuple[Counter, int]:
        """The pairs (plus, minus) that differ, with the number of times each was made, and the number of all that were made."""
        pairs: Counter = Counter()
        made = 0
        text = text.lower()
        self.learn([*WORD.findall(text), *self.terms])
        known = self.known
        for m in SENTENCE.finditer(text):
            sentence = m[0]
            named = list(TERM.finditer(sentence))
            words = [(w.start(), w[0]) for w in WORD.finditer(sentence)]
            if named:
                places = [(t.start(), t[1], SWAPS[t[1]]) for t in named]
            else:
                plain = [(at, w) for at, w in words if len(w) > 3 and not known[w]]
                if not plain:
                    continue
                choice = zlib.crc32(sentence.encode())
                places = [(*plain[choice % len(plain)], KIND_LIST[choice // 7 % len(KIND_LIST)])]
            for at, term, others in places:
                made += len(others)
                mine = known[term]
                if not mine and not any(self.terms[o] for o in others):
                    continue
                rest = frozenset().union(*(known[w] for start, w in words if start != at))
                for other in others:
                    plus, minus = mine - self.terms[other] - rest, self.terms[other] - mine - rest
                    if plus or minus:
                        pairs[tuple(sorted(plus)), tuple(sorted(minus))] += 1
        return pairs, made


@dataclass
class Model:
    slots: np.ndarray
    weights: np.ndarray
    intercept: float
    #: Counterfactuals that the sample gave, and those among them that differ in a feature of the model.
    made: int = 0
    differing: int = 0

    def __post_init__(self) -> None:
        self.keep = np.zeros(1 << BITS, bool)
        self.keep[self.slots] = True
        self.table = np.zeros(1 << BITS)
        self.table[self.slots] = self.weights

    def __getstate__(self):
        return self.slots, self.weights, self.intercept, self.made, self.differing

    def __setstate__(self, state):
        self.slots, self.weights, self.intercept, self.made, self.differing = state
        self.__post_init__()

    def scores(self, texts: pa.Array) -> np.ndarray:
        data, bounds = text_bytes(pc.utf8_lower(texts))
        out = np.full(len(texts), self.intercept)
        for i, j in blocks(bounds):
            own = bounds[i : j + 1]
            doc, slot, n = counts_of(data[own[0] : own[-1]], own - own[0], self.keep)
            out[i:j] += np.bincount(doc, self.table[slot] * value(n), j - i)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -40, 40)))


def sampled(labels: DataFrame, most_positive: int = MAX_POSITIVE, most_negative: int = MAX_NEGATIVE) -> DataFrame:
    """Bounded numbers of toxic and other labelled documents, by the hash of their id, with the rows each stands for."""
    one = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in one.select((F.col("toxic") > 0).cast("int").alias("toxic")).groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def part(toxic: int, most: int) -> DataFrame:
        weight = max(1.0, sizes.get(toxic, 0) / most)
        rows = one.where((F.col("toxic") > 0) == bool(toxic)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        return rows.select("doc_id", F.lit(toxic).alias("toxic"), F.lit(weight).alias("weight"))

    return part(1, most_positive).unionByName(part(0, most_negative))


def labelled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row (text, toxic, weight) for each distinct text of a sampled document; texts of one id share its weight.

    Copies of a row add nothing. An id with several texts has a row for each, and all of them weigh what the id stands for.
    """
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # chosen is bounded by the sample's two limits
    rows = stored(joined.dropDuplicates(["doc_id", "text"]), "labelled-texts")
    several = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.join(F.broadcast(several), "doc_id", "left")  # at most one row per sampled id
    return shared.select("text", "toxic", (F.col("weight") / F.coalesce("n", F.lit(1))).alias("weight"))


def fit(labelled: DataFrame, counterfactual: float = COUNTERFACTUAL) -> Model:
    """A model from rows of (text, toxic, weight), whose number the caller bounds; see `sampled`.

    The features that tell the labels apart are selected by an aggregation over all slots, as many as have the gain; the sample's
    bound bounds them. The texts are then counted over these alone, and the fit runs in one task on the sample's counts.
    """
    rows = stored(labelled.select("text", F.col("toxic").cast("int").alias("toxic"), F.col("weight").cast("double").alias("weight")), "labelled")
    sums = rows.agg(F.sum("weight").alias("all"), F.sum(F.col("weight") * F.col("toxic")).alias("toxic")).first()
    base = (sums["toxic"] or 0.0) / sums["all"] if sums["all"] else 0.0
    if base <= 0 or base >= 1:
        return Model(np.zeros(0, np.int64), np.zeros(0), -40.0 if base <= 0 else 40.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(pc.utf8_lower(text_array(batch.column(0))))
            toxic, weight = batch.column(1).to_numpy().astype(np.float64), batch.column(2).to_numpy()
            for i, j in blocks(bounds, 4 << 20):
                own = bounds[i : j + 1]
                doc, slot, _ = counts_of(data[own[0] : own[-1]], own - own[0])
                slots, at, seen = np.unique(slot, return_inverse=True, return_counts=True)
                w = weight[i:j][doc]
                columns = (slots, seen, np.bincount(at, w), np.bincount(at, w * toxic[i:j][doc]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "seen", "w_all", "w_toxic"])

    # Distance of the toxic share among texts with the feature from the base share, in standard errors.
    by_slot = rows.mapInArrow(count, "slot long, seen long, w_all double, w_toxic double").groupBy("slot").agg(
        F.sum("seen").alias("seen"), F.sum("w_all").alias("w_all"), F.sum("w_toxic").alias("w_toxic"))
    expected = F.col("w_all") * base
    gain = (F.col("w_toxic") - expected) / F.sqrt(F.greatest(expected * (1 - base), F.lit(0.5)))
    best = by_slot.where(F.col("seen") >= MIN_TEXTS).select("slot", gain.alias("gain")).where(F.col("gain") > MIN_GAIN)
    chosen = np.sort(best.select("slot").toArrow().column("slot").to_numpy()).astype(np.int64)
    if not len(chosen):
        return Model(chosen, np.zeros(0), float(np.log(base / (1 - base))))
    pair = pa.struct([("plus", pa.list_(pa.int32())), ("minus", pa.list_(pa.int32())), ("n", pa.int64())])
    kinds = (pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pair), pa.int64())
    names = ["toxic", "weight", "features", "counts", "pairs", "made"]
    schema = "toxic int, weight double, features array<int>, counts array<int>, pairs array<struct<plus: array<int>, minus: array<int>, n: bigint>>, made bigint"

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(1 << BITS, bool)
        keep[chosen] = True

        def features_of(text: str) -> tuple[np.ndarray, np.ndarray]:
            raw = np.frombuffer(text.lower().encode(), np.uint8)
            _, slot, n = counts_of(raw, np.array([0, len(raw)]), keep)
            return np.searchsorted(chosen, slot), n

        def of_words(words: list[str]) -> list[list[int]]:
            raw = [w.encode() for w in words]
            doc, slot, _ = counts_of(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(w) for w in raw]))), keep)
            at = np.searchsorted(doc, np.arange(len(words) + 1))
            found = np.searchsorted(chosen, slot).tolist()
            return [found[a:b] for a, b in zip(at[:-1], at[1:])]

        swapped = Counterfactuals(of_words)
        for batch in batches:
            out: list[tuple] = []
            for text, toxic, weight in zip(text_array(batch.column(0)), batch.column(1), batch.column(2)):
                text = text.as_py()
                f, n = features_of(text)
                pairs, made = swapped.of(text)
                listed = [{"plus": plus, "minus": minus, "n": k} for (plus, minus), k in pairs.items()]
                out.append((toxic.as_py(), weight.as_py(), f.astype(np.int32), n.astype(np.int32), listed, made))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names=names)

    def train(group: pa.Table) -> pa.Table:
        y, weight = group.column("toxic").to_numpy().astype(np.float64), group.column("weight").to_numpy()
        lists = group.column("features").to_pylist()
        doc = np.repeat(np.arange(len(y)), [len(x) for x in lists])
        feature, n = (np.array([v for x in column for v in x], np.int64) for column in (lists, group.column("counts").to_pylist()))
        pairs: Counter = Counter()
        for row in group.column("pairs").to_pylist():
            for p in row:
                pairs[tuple(p["plus"]), tuple(p["minus"])] += p["n"]
        w, b = trained(y, weight, doc, feature, n, sorted(pairs.items()), len(chosen), counterfactual)
        made = sum(group.column("made").to_pylist())
        return pa.table({"feature": pa.array([*range(len(w)), -1, -2, -3], pa.int32()), "w": pa.array([*w.tolist(), b, float(made), float(sum(pairs.values()))], pa.float64())})

    fitted = rows.mapInArrow(reduce, schema).withColumn("fit", F.lit(0)).groupBy("fit").applyInArrow(train, "feature int, w double").toArrow()
    weights = dict(zip(fitted.column("feature").to_pylist(), fitted.column("w").to_pylist()))
    return Model(chosen, np.array([weights[k] for k in range(len(chosen))]), weights[-1], int(weights[-2]), int(weights[-3]))


def trained(y, weight, doc, feature, n, pairs, size, counterfactual):
    """Weights and intercept: weighted logistic loss, ridge, and the counterfactual penalty, the mean of the pairs' squared score
    changes. Pairs are ((features of the one side, of the other), number)."""
    rows, cols, signs = [], [], []
    times = np.array([k for _, k in pairs], np.float64)
    for k, ((plus, minus), _) in enumerate(pairs):
        rows += [k] * (len(plus) + len(minus))
        cols += [*plus, *minus]
        signs += [np.log(2.0)] * len(plus) + [-np.log(2.0)] * len(minus)
    rows, cols, signs = np.array(rows, np.int64), np.array(cols, np.int64), np.array(signs)
    v, share = value(n), weight / weight.sum()
    base = float((y * share).sum())
    w, b = np.zeros(size), float(np.log(base / (1 - base)))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):  # full-batch Adam on a problem of bounded size
        z = b + np.bincount(doc, w[feature] * v, len(y))
        error = (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y) * share
        grad = np.bincount(feature, error[doc] * v, size) + RIDGE * w
        if len(rows):
            change = np.bincount(rows, w[cols] * signs, len(pairs))
            grad += counterfactual * 2.0 / times.sum() * np.bincount(cols, (times * change)[rows] * signs, size)
        g = np.append(grad, error.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score(docs: DataFrame, model: Model, text: str = "text", into: tuple[str, str] = ("score", "predicted"), threshold: float = THRESHOLD) -> DataFrame:
    """Every row with its score from 0 to 1 and whether it reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES slots and weights

    def make(texts: pa.Array) -> list[pa.Array]:
        p = shared.value.scores(texts)
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    return with_columns(docs, text, {into[0]: T.DoubleType(), into[1]: T.IntegerType()}, make)
