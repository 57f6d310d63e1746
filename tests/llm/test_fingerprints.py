import hashlib
import math
from collections import Counter

import numpy as np

from hexwatch.llm import fingerprints as fp
from hexwatch.llm.queries import QUERIES


def brute_levels(data):
    most = int(fp._SUMS[fp.WINDOW])
    return [(most - sum(int(fp._SUMS[c]) for c in Counter(data[i : i + 64]).values())) * fp.LEVELS // most for i in range(len(data) - 63)]


def brute_filters(data, ranks):
    """Filters of one text, window by window."""
    if not data:
        return np.zeros((0, 256), np.uint8)
    if len(data) < 64:
        chosen = [(0, len(data))]
    else:
        rank = [int(ranks[x]) for x in brute_levels(data)]
        votes = Counter()
        for a in range(-63, len(rank)):
            near = [(rank[i], i) for i in range(max(0, a), min(len(rank), a + 64)) if rank[i] < fp.NONE]
            if near:
                votes[min(near)[1]] += 1
        chosen = [(i, i + 64) for i in sorted(votes) if votes[i] >= fp.VOTES]
    seen, rows = [], []
    for a, b in chosen:
        h = 0
        for k, byte in enumerate(data[a:b]):
            h = (h + (byte + 1) * pow(int(fp.SpanHash(np.zeros(2, np.uint8))._up[1]), k, 1 << 64)) % (1 << 64)
        h = int(fp.mix(np.array([(h + b - a) % (1 << 64)], np.uint64))[0])
        if h not in seen:
            seen.append(h)
    for k in range(0, len(seen), fp.FILTER_FEATURES):
        bits = np.zeros(fp.FILTER_BITS, np.uint8)
        for h in seen[k : k + fp.FILTER_FEATURES]:
            for j in range(fp.HASHES):
                bits[h >> 11 * j & 2047] = 1
        rows.append(np.packbits(bits))
    return np.array(rows, np.uint8).reshape(-1, 256)


def sample_texts():
    rng = np.random.default_rng(7)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(300)]
    make = lambda n: " ".join(words[i] for i in rng.integers(0, 300, n))
    return [b"", b"short", make(11)[:63].encode(), make(20)[:64].encode(), make(60).encode(), b"a" * 300, make(2500).encode(), ("same line again\n" * 40).encode(), make(30).encode()]


def test_entropy_and_filters_against_brute_force():
    texts = sample_texts()
    for t in texts:
        assert fp.entropy_levels(np.frombuffer(t, np.uint8)).tolist() == brute_levels(t)
    histogram = np.zeros(fp.LEVELS + 1, np.int64)
    for t in texts:
        np.add.at(histogram, brute_levels(t), 1)
    ranks = fp.ranks_of(histogram)
    found = fp.filters_of(texts, ranks)
    for t, f in zip(texts, found):
        assert (f == brute_filters(t, ranks)).all()
    alone = fp.filters_of(texts[6:7], ranks)[0]
    assert (alone == found[6]).all()  # neighbours in a block do not matter


def test_long_blocks_cross_segments():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 110, fp.SEGMENT * 2 + 500).astype(np.uint8)
    levels = fp.entropy_levels(data)
    for i in [*range(0, len(levels), 7919), *range(fp.SEGMENT - 70, fp.SEGMENT + 70, 9), len(levels) - 1]:
        counts = np.bincount(data[i : i + 64])
        most = int(fp._SUMS[64])
        assert levels[i] == (most - int(fp._SUMS[counts].sum())) * fp.LEVELS // most


def test_likeness_orders():
    texts = sample_texts()
    big = texts[6]
    ranks = fp.ranks_of(np.bincount(fp.entropy_levels(np.frombuffer(big, np.uint8)), minlength=fp.LEVELS + 1))
    half = big[: len(big) // 2]
    a, b, c, none = fp.filters_of([big, big.replace(b" a", b" b", 3), texts[4], b""], ranks)
    assert fp.likeness(a, a) == 1.0 and fp.likeness(none, none) == 1.0 and fp.likeness(a, none) == 0.0
    part = fp.filters_of([half], ranks)[0]
    assert fp.likeness(a, b) > 0.6 and fp.likeness(part, a) > 0.2 > fp.likeness(c, a)
    assert (fp.parsed(fp.shown(a)) == a).all()


def test_query_in_order(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"), QUERIES["op6_improbable_features"](spark, sf).collect())


def check(docs, rows):
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    texts.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = {}
    for k, (i, t) in enumerate(texts):
        new = fp.edited(t, texts[(k + 1) % len(texts)][1])
        want.setdefault((i, len(t), hashlib.sha256(new.encode()).hexdigest()), []).append(k)
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == Counter({k: len(v) for k, v in want.items()})
    prints = {}
    for r in rows:
        k = want[r["doc_id"], r["n_chars"], r["edited_sha256"]][0]
        assert prints.setdefault(texts[k][1], r["fingerprint"]) == r["fingerprint"]
        a, b = fp.parsed(r["fingerprint"]), fp.parsed(r["edited_fingerprint"])
        assert math.isclose(r["near_edited"], fp.likeness(a, b)) and 0 <= r["near_next"] <= 1


def test_ranges_odd_rows_and_ties(odd, empty, docs_of, monkeypatch):
    monkeypatch.setattr(fp, "PART_BYTES", 9000)
    check(odd, fp.compared(odd).collect())
    many = docs_of([(k * 3 % 101, f"text {k} " * (k % 60)) for k in range(300)])
    check(many, fp.compared(many).collect())
    assert fp.compared(empty).count() == 0
    one = fp.compared(docs_of([(1, "alone here")])).collect()
    assert one[0]["near_next"] == 1.0
