import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hexwatch.llm import neardup
from hexwatch.llm.common import text_bytes


def words_of(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def shingle_counts(text):
    w = words_of(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows, similarity=0.8):
    """Class of each row by exact weighted Jaccard over all pairs."""
    texts = {}
    for k, (_, t) in enumerate(rows):
        texts.setdefault(t or "", []).append(k)
    keys = list(texts)
    counts = [shingle_counts(t) for t in keys]
    df = Counter(s for c in counts for s in c)
    n = len(keys)

    def weight(s, tf):
        return (1 + math.log(tf)) * (1 + neardup.IDF_STRENGTH * math.log(max(1.0, n / max(df[s], neardup.RARE))) / math.log(max(n, 2)))

    weights = [{s: weight(s, tf) for s, tf in c.items()} for c in counts]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(n), 2):
        both = sum(min(weights[a][s], weights[b][s]) for s in weights[a].keys() & weights[b].keys())
        total = sum(weights[a].values()) + sum(weights[b].values()) - both
        if both and both / total >= similarity:
            root[find(a)] = find(b)
    classes = {}
    for k, t in enumerate(keys):
        classes.setdefault(find(k), []).extend(texts[t])
    out = {}
    for members in classes.values():
        ids = [rows[m][0] for m in members if rows[m][0] is not None]
        for m in members:
            out[m] = min(ids) if ids else None
    return [out[k] for k in range(len(rows))]


def corpus(seed=3, n=40):
    """Texts with exact copies, groups of near copies of several degrees, a shared passage, and repeated lines."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for k in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 220))]
        if k % 3 == 0:
            base = base[:20] + passage + base[20:]
        rows.append(" ".join(base))
        for edits in ([1] * 6 + [2] * 6 + [4] * 4 + [8] * 4) if k % 8 == 0 else ([1, 3] if k % 4 == 1 else []):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
        if k % 5 == 0:
            rows += [rows[-1]] * 3
        if k % 7 == 0:
            rows.append("again and again the same line\n" * 10 + " ".join(base[:12]))
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[j]) for i, j in enumerate(order)]


def test_classes_against_all_pairs(docs_of):
    rows = corpus()
    got = {r["doc_id"]: r["class_id"] for r in neardup.class_of_documents(docs_of(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_pairs_left_after_the_rounds(docs_of, monkeypatch):
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    rows = corpus(11, 24)
    got = {r["doc_id"]: r["class_id"] for r in neardup.class_of_documents(docs_of(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_odd_texts(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = Counter((r["doc_id"], r["class_id"]) for r in neardup.class_of_documents(odd).collect())
    assert got == Counter(zip((r[0] for r in rows), brute(rows)))
    assert neardup.class_of_documents(empty).count() == 0


def test_one_of_each_class_stays(docs_of, odd, empty):
    rows = corpus(5, 20)
    docs = docs_of([(i, t, "en", "s") for i, t in rows]).withColumnRenamed("source", "tid").withColumnRenamed("lang", "root")
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute(rows)))
    again = neardup.one_of_each(docs.union(docs))  # repeated rows
    assert sorted(r["doc_id"] for r in again.collect()) == sorted(set(brute(rows)))
    assert neardup.one_of_each(odd).count() == len({(t or "") for _, t in ((r["doc_id"], r["text"]) for r in odd.collect())})
    assert neardup.one_of_each(empty).count() == 0


def test_shingles_do_not_cross_texts():
    texts = ["a b c d e f", "", "a b c", "g. h, i; J k l", "f g h i j k l", "  "]
    h, d = neardup.shingles(*text_bytes(pa.array([t.lower() for t in texts])))
    counts = [len(shingle_counts(t)) for t in texts]
    assert np.bincount(d, minlength=len(texts)).tolist() == counts
    same = set(h[d == 3]) & set(h[d == 4])
    assert len(same) == 2


def test_sorted_hashes_round_trip():
    rng = np.random.default_rng(1)
    for values in (rng.integers(0, 1 << 62, 1000, dtype=np.uint64), rng.integers(0, 1 << 40, 5000, dtype=np.uint64), np.zeros(3, np.uint64), np.zeros(0, np.uint64), np.array([7], np.uint64)):
        values = np.sort(values)
        assert (neardup.unpack_sorted(neardup.pack_sorted(values)) == values).all()


@pytest.mark.parametrize("private", [0.0, 30.0])
def test_samples_agree_as_often_as_the_sets_are_alike(private):
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    w = rng.uniform(0.5, 3.0, 300)
    w2 = np.where(rng.random(300) < 0.3, w * 0.5, w)
    likeness = np.minimum(w, w2).sum() / (np.maximum(w, w2).sum() + 2 * private)
    both = neardup.samples(np.concatenate((h, h)), np.concatenate((w, w2)), np.array([0, 300]), np.array([private, private]), np.array([1, 2], np.uint64), 3000)
    assert abs((both[0] == both[1]).mean() - likeness) < 0.03


def test_least_values_are_exponential():
    """A set's least value has the rate of its total weight, so private shingles can take part as one draw."""
    rng = np.random.default_rng(4)
    h, w = rng.integers(0, 1 << 62, 50, dtype=np.uint64), rng.uniform(0.2, 2.0, 50)
    least = []
    for k in range(4000):
        u1, u2, u3, u4, beta = neardup.uniforms(h, k)
        r = -np.log(u1 * u2)
        level = np.floor(np.log(w) / r + beta)
        least.append(np.exp(np.log(-np.log(u3 * u4)) - r * (level - beta) - r).min())
    assert abs(np.mean(least) * w.sum() - 1) < 0.06
