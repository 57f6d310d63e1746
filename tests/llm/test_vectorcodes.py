import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hexwatch.llm import vectorcodes as V


def nearest(x, e):
    far = ((x[:, None, :] - e[None, :, :]) ** 2).sum(2)
    return far.argmin(1), far.min(1)


def plain(rows, parts=4, entries=256, rounds=4):
    """Lloyd by every distance over (vec_id, vector, label) rows."""
    kept = [(i, np.array([int(np.floor(np.float64(x) * 1024)) for x in v]), label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) and abs(x) < 2**18 for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    x = np.array([v for _, v, _ in kept]).reshape(len(kept), parts, -1).transpose(1, 0, 2)
    books = x[:, :entries].copy()
    for _ in range(rounds):
        for p in range(parts):
            code = nearest(x[p], books[p])[0]
            for e in set(code.tolist()):
                books[p, e] = x[p][code == e].sum(0) // (code == e).sum()
    found = [nearest(x[p], books[p]) for p in range(parts)]
    error = sum(f[1] for f in found)
    totals = {}
    for (_, _, label), e in zip(kept, error.tolist()):
        totals[label] = totals.get(label, 0) + e
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return sorted(((i, "".join(f"{f[0][k]:02x}" for f in found), int(error[k]), totals[label], digest) for k, (i, _, label) in enumerate(kept)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 60), st.integers(1, 5), st.sampled_from([1, 3, 50, 10**6]), st.sampled_from([1, 4, 16]))
def test_dual_trees_assign_as_every_distance_does(seed, n, k, d, spread, leaf):
    rng = np.random.default_rng(seed)
    x, e = rng.integers(-spread, spread + 1, (n, d)), rng.integers(-spread, spread + 1, (k, d))
    tree, entries = V.tree_over(x, leaf), V.EntryTree.of(e)
    codes, sums, counts, _ = V.assign(V.restored(V.packed_tree(tree), n, d, leaf) if spread < 10**6 else tree, entries)
    right = nearest(x, e)[0]
    assert (codes == right[tree.order]).all()
    assert (counts == np.bincount(right, minlength=k)).all()
    assert all((sums[j] == x[right == j].sum(0)).all() for j in range(k))


def test_trees_save_comparisons():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (64, 8))
    x = (centres[rng.integers(0, 64, 8000)] + rng.integers(-60, 60, (8000, 8)))
    done = V.assign(V.tree_over(x, 16), V.EntryTree.of(centres))[3]
    assert done["whole"] > 6000 and done["compared"] < 0.05 * 8000 * 64
    same = V.assign(V.tree_over(np.repeat(x[:1], 5000, 0), 16), V.EntryTree.of(centres))[3]
    assert same["whole"] == 5000 and same["pairs"] < 200  # copies are one node


def test_given_vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert found(V.compressed(rows)) == plain([tuple(r) for r in rows.collect()])


@pytest.mark.parametrize("block_rows, leaf_rows, slices", [(7, 1, 3), (100, 16, 1)])
def test_odd_rows(spark, block_rows, leaf_rows, slices):
    rng = np.random.default_rng(3)
    rows = [(int(i) if i % 11 else None, rng.normal(0, 1, 8).astype(np.float32).tolist(), int(i) % 3 if i % 5 else None) for i in range(90)]
    rows += [(5, rows[4][1], 1), (5, rows[4][1], 1), (6, [0.0] * 8, None), (7, [-0.0] * 8, None)] + [(100 + i, [1.5] * 8, 7) for i in range(40)]
    bad = [(1, None, 1), (2, [None] + [0.0] * 7, 1), (0, [float("nan")] * 8, 1), (0, [float("inf")] * 8, 1), (0, [3e38] * 8, None)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").selectExpr("'x' as code", "*", "1 as error", "2 as vector").repartition(slices)
    assert found(V.compressed(df, block_rows=block_rows, leaf_rows=leaf_rows)) == plain(rows)


def test_other_lengths_and_empty(spark):
    rows = [(i, [float(i), 0.5, 1.0, 2.0], 1) for i in range(3)]
    df = spark.createDataFrame([*rows, (9, [1.0], 1), (10, [], None)], "vec_id long, embedding array<float>, label int")
    got = found(V.compressed(df))
    digest = got[0][4]
    assert got == sorted([*plain(rows), (9, None, None, None, digest), (10, None, None, None, digest)], key=repr)
    assert found(V.compressed(df.where("vec_id = 9"))) == [(9, None, None, None, hashlib.sha256(b"").hexdigest())]
    assert V.compressed(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        V.compressed(df, entries=257)
