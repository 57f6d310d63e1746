import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexwatch.operators import boosting as B
from hexwatch.operators import model

INPUTS = ["a", "b", "c d"]


def data(n=600, seed=4):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 6, n).astype(float), rng.normal(0, 1, n).round(2), rng.integers(0, 3, n).astype(float)
    y = ((a > 2) ^ (b > 0.3) | (rng.random(n) < 0.1)).astype(int)
    rows = [[None if rng.random() < 0.15 else float(v) for v in r] for r in zip(a, b, c)]
    for r, t in zip(rows, y):
        if t and rng.random() < 0.5:
            r[2] = None  # that it is missing says something
    rows[5][1] = float("nan")
    return rows, y.tolist()


@pytest.fixture(scope="module")
def table(spark):
    rows, y = data()
    df = spark.createDataFrame([(*r, t, k) for k, (r, t) in enumerate(zip(rows, y))] + [(1.0, 1.0, 1.0, None, -1)], "a double, b double, `c d` double, y int, k int")
    return df.repartition(5).cache()


def bins_of(rows, edges):
    return [[0 if x is None or x != x else 1 + sum(e <= x for e in edges[f]) for f, x in enumerate(r)] for r in rows]


def plain_best(own, bins, g, h, params):
    """The best split of some rows by trying all."""
    best = None
    G, H = sum(g[i] for i in own), sum(h[i] for i in own)
    q = lambda g, h: (g / B.FIXED_POINT) ** 2 / (h / B.FIXED_POINT + params.l2)
    for f in range(len(bins[0])):
        for b in sorted({bins[i][f] for i in own} - {0}):
            for missing_left in (True, False):
                left = [i for i in own if (bins[i][f] <= b if bins[i][f] else missing_left)]
                lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                gain = (q(lg, lh) + q(G - lg, H - lh) - q(G, H)) / 2
                least = params.min_child_weight * B.FIXED_POINT
                if left and len(left) < len(own) and lh >= least and H - lh >= least and gain > B.NOISE:
                    key = (gain, -f, -b, missing_left)
                    if best is None or key > best[0]:
                        best = (key, f, b, missing_left, left)
    return best


def plain_tree(bins, g, h, params):
    """Splits by node: depth first, or the leaf of the greatest gain again and again."""
    everything = list(range(len(bins)))
    splits, heap = {}, []

    def offer(node, own, depth):
        if depth < params.max_depth and (best := plain_best(own, bins, g, h, params)):
            heapq.heappush(heap, (-best[0][0] if params.growth == "leaf" else node, node, own, depth, best))

    offer(0, everything, 0)
    while heap and (params.growth == "level" or len(splits) < params.leaves - 1):
        _, node, own, depth, best = heapq.heappop(heap)
        splits[node] = best[1:4]
        left = set(best[4])
        offer(2 * node + 1, best[4], depth + 1)
        offer(2 * node + 2, [i for i in own if i not in left], depth + 1)
    return splits


@pytest.mark.parametrize("growth, leaves, depth", [("level", 31, 3), ("leaf", 6, 6), ("leaf", 3, 8), ("leaf", 20, 4)])
def test_splits_against_brute_force(table, growth, leaves, depth):
    params = B.Params(growth, trees=1, max_depth=depth, leaves=leaves, bins=8)
    rows, y = data()
    edges = B.quantile_edges(table.where("y is not null"), INPUTS, params.bins)
    fitted = B.fit(table, INPUTS, "y", params)
    share = sum(y) / len(y)
    p = 1 / (1 + math.exp(-math.log(share / (1 - share))))
    g = [round((p - t) * B.FIXED_POINT) for t in y]
    h = [round(p * (1 - p) * B.FIXED_POINT)] * len(y)
    expected = plain_tree(bins_of(rows, edges), g, h, params)
    assert {n: (s.feature, s.bin, s.missing_left) for n, s in fitted.trees[0].splits.items()} == expected
    assert len(fitted.trees[0].values) == len(expected) + 1


def test_bins(table):
    rows, y = data()
    edges = B.quantile_edges(table, INPUTS, 16)
    assert all(e == sorted(set(e)) and len(e) < 16 for e in edges) and edges[0] == [1, 2, 3, 4, 5]
    got = B.binned(table.where("k >= 0").orderBy("k").coalesce(1), INPUTS, edges, "y").collect()
    assert [[r["b0"], r["b1"], r["b2"]] for r in got] == bins_of(rows, edges) and [r["y"] for r in got] == y


@pytest.mark.parametrize("growth", ["level", "leaf"])
def test_loss_falls_and_scores_agree_with_bins(table, growth):
    params = B.Params(growth, trees=4, max_depth=2, leaves=4, learning_rate=0.5, store_every=2)
    m = B.fit(table, INPUTS, "y", params)
    assert len(m.trees) == 4

    def loss(model_):
        r = model_.risk()
        return table.where("y is not null").agg(F.avg(-F.col("y") * F.log(r) - (1 - F.col("y")) * F.log(1 - r))).first()[0]

    losses = [loss(B.BoostedModel(m.inputs, m.base, m.trees[:k], params)) for k in range(5)]
    assert all(a > b for a, b in zip(losses, losses[1:])) and losses[-1] < 0.8 * losses[0]
    # Conditions on values and on bins lead to the same leaves.
    edges = B.quantile_edges(table.where("y is not null"), INPUTS, params.bins)
    on_bins = B.binned(table.where("y is not null").orderBy("k").coalesce(1), INPUTS, edges, "y")
    total = F.lit(m.base)
    for t in m.trees:
        total = total + F.expr(t.sql(B.goes_left, t.value))
    a = [r[0] for r in on_bins.select(total).collect()]
    b = [r[0] for r in table.where("y is not null").orderBy("k").coalesce(1).select(m.margin()).collect()]
    assert a == pytest.approx(b)


def test_rerun_gives_the_same_trees(table):
    params = B.Params(trees=2, max_depth=2)
    assert B.fit(table, INPUTS, "y", params).trees == B.fit(table.repartition(3), INPUTS, "y", params).trees


def test_save_and_load(spark, table, tmp_path):
    m = B.fit(table, INPUTS, "y", B.Params("leaf", trees=2, leaves=5))
    m.save(spark, str(tmp_path / "m"))
    assert B.BoostedModel.load(spark, str(tmp_path / "m")) == m


def test_one_kind_and_empty(spark, table):
    ones = B.fit(table.where("y = 1"), INPUTS, "y", B.Params())
    none = B.fit(table.limit(0), INPUTS, "y", B.Params())
    assert not ones.trees and not none.trees
    assert table.select(ones.risk()).first()[0] > 0.99 and table.select(none.risk()).first()[0] < 0.01
    constant = spark.createDataFrame([(1.0, None, 2.0, k % 2) for k in range(20)], "a double, b double, `c d` double, y int")
    assert not B.fit(constant, INPUTS, "y", B.Params()).trees
    with pytest.raises(ValueError):
        B.Params("breadth")


def test_a_level_is_one_exchange(spark, tmp_path):
    spark.range(100).selectExpr("cast(id % 3 as smallint) as b0", "cast(1 as smallint) as b1", "cast(id % 2 as int) as y").write.parquet(str(tmp_path / "b"))
    plan = B.histogram(spark.read.parquet(str(tmp_path / "b")), F.lit(0), F.lit(0.0), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


@pytest.mark.parametrize("kind", ["xgboost", "lightgbm"])
def test_trainers_by_name(spark, kind):
    rng = np.random.default_rng(2)
    rows = [tuple([int(v) for v in rng.integers(0, 5, len(model.INPUTS))]) for _ in range(400)]
    df = spark.createDataFrame([(*r, int(r[0] + r[8] > 4)) for r in rows], ", ".join(f"{c} int" for c in model.INPUTS) + ", target_binary int")
    m = model.train(df, kind, trees=2, max_depth=3, learning_rate=0.9)
    assert m.params.growth == {"xgboost": "level", "lightgbm": "leaf"}[kind]
    scored = model.score(m, df)
    assert scored.where((F.col("risk") > 0.5) != (F.col("target_binary") == 1)).count() < 60
    with pytest.raises(ValueError):
        model.train(df, "forest")
