"""M3: second-order gradient boosting of trees over binned inputs, by aggregations.

Inputs are cut at quantiles once and stored as small bin numbers; bin 0 holds missing values. A level of a tree is one
aggregation by (node, input, bin) of the gradients and Hessians of the logistic loss, combined in each task before the exchange, so
that what is shuffled is bounded by nodes x inputs x bins a task, not by rows. The best split of every node comes from running sums
over its bins; for each split the missing values are tried on both sides. Only the best splits reach the driver.

`level`: every node of a level is split while that gains, down to a depth. `leaf`: the tree has a number of leaves, and the splits
are those that taking the leaf of the greatest gain again and again would make. These are the splits with the greatest
least gain on the way from the root, so whole levels can be looked at in one aggregation here as well, and nodes that too many
others surpass are left out, with all below them.

Gradients are summed as integers: sums do not depend on the order of rows, so a task that is run again cannot change a split.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexwatch.session import shared_dir

#: Gradients are at most 1, so sums of 2^43 rows fit 64 bits.
FIXED_POINT = 1 << 20
MISSING = 0
#: Gains below this are rounding.
NOISE = 1e-9
HISTOGRAM = ("node", "feature", "bin")


@dataclass
class Params:
    growth: str = "level"
    trees: int = 50
    max_depth: int = 6
    leaves: int = 31
    learning_rate: float = 0.3
    l2: float = 1.0
    min_gain: float = 0.0
    min_child_weight: float = 1.0
    bins: int = 64
    #: After so many trees the rows are stored with their margins, so that later passes do not walk these trees again.
    store_every: int = 8

    def __post_init__(self) -> None:
        if self.growth not in ("level", "leaf"):
            raise ValueError(f"growth must be level or leaf, is {self.growth!r}")
        if self.max_depth > 60:
            raise ValueError("trees deeper than 60 levels are not supported")


@dataclass
class Split:
    """Rows with an input below `threshold` go left (with any known value if it is None), missing ones if `missing_left`."""

    feature: int
    bin: int
    threshold: float | None
    missing_left: bool
    gain: float


@dataclass
class Tree:
    """Children of node i are 2i+1 and 2i+2."""

    splits: dict[int, Split] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def sql(self, test, leaf, node: int = 0) -> str:
        """A CASE over the splits: `test(split)` is the condition to go left, `leaf(node)` what stands at an end."""
        if node not in self.splits:
            return leaf(node)
        split = self.splits[node]
        return f"CASE WHEN {test(split)} THEN {self.sql(test, leaf, 2 * node + 1)} ELSE {self.sql(test, leaf, 2 * node + 2)} END"

    def value(self, node: int) -> str:
        return f"{self.values[node]!r}D"


def known(c: Column) -> Column:
    """An input as a number, NaN as missing."""
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def quantile_edges(rows: DataFrame, inputs: list[str], bins: int) -> list[list[float]]:
    """At most bins - 1 increasing edges per input, all of them values of it; one aggregation for all inputs."""
    at = [i / bins for i in range(bins)]
    found = rows.agg(*(F.percentile_approx(known(F.col(c)), at, 100 * bins).alias(f"q{i}") for i, c in enumerate(inputs))).first()
    lows = rows.agg(*(F.min(known(F.col(c))).alias(f"q{i}") for i, c in enumerate(inputs))).first()
    return [sorted({e for e in found[i] or [] if e > lows[i]}) for i in range(len(inputs))]


def binned(rows: DataFrame, inputs: list[str], edges: list[list[float]], label: str) -> DataFrame:
    """b0, b1, ... of the inputs, and y: bin k > 0 holds values with k - 1 edges at or below them."""
    out = rows.select(*(known(F.col(c)).alias(f"x{i}") for i, c in enumerate(inputs)), F.col(label).cast("int").alias("y"))
    cut = [i for i, e in enumerate(edges) if e]
    if cut:
        out = Bucketizer(splitsArray=[[-math.inf, *edges[i], math.inf] for i in cut], inputCols=[f"x{i}" for i in cut],
                         outputCols=[f"c{i}" for i in cut], handleInvalid="keep").transform(out)
    number = [F.col(f"c{i}") + 1 if i in cut else F.when(F.col(f"x{i}").isNotNull(), 1) for i in range(len(inputs))]
    return out.select(*(F.coalesce(n, F.lit(MISSING)).cast("smallint").alias(f"b{i}") for i, n in enumerate(number)), "y")


def goes_left(split: Split) -> str:
    """The split's condition on bins."""
    at = f"b{split.feature}"
    return f"({at} <= {split.bin})" if split.missing_left else f"({at} <= {split.bin} AND {at} > {MISSING})"


def histogram(rows: DataFrame, node: Column, margin: Column, features: int) -> DataFrame:
    """Sums of gradients and Hessians and the number of rows by (node, feature, bin); rows whose node is null are left out."""
    p = 1 / (1 + F.exp(-margin))

    def whole(c: Column) -> Column:
        return F.round(c * FIXED_POINT).cast("bigint")

    graded = rows.select(node.cast("bigint").alias("node"), p.alias("p"), "y", *(f"b{i}" for i in range(features))).where("node is not null")
    cells = F.array(*(F.struct(F.lit(i).alias("feature"), F.col(f"b{i}").cast("int").alias("bin")) for i in range(features)))
    long = graded.select("node", whole(F.col("p") - F.col("y")).alias("g"), whole(F.col("p") * (1 - F.col("p"))).alias("h"), F.inline(cells))
    return long.groupBy(*HISTOGRAM).agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))


def best_splits(cells: DataFrame, params: Params) -> DataFrame:
    """The split of greatest gain for every node that has one; of equal gains that of the first input, then the first bin,
    then with missing values on the left. With it the sums of both sides."""
    group = Window.partitionBy("node", "feature")
    upward = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    present = F.col("bin") > MISSING
    sums = cells.select(
        *HISTOGRAM,
        *(F.sum(c).over(group).alias(f"all_{c}") for c in "ghn"),
        *(F.coalesce(F.sum(F.when(~present, F.col(c))).over(group), F.lit(0)).alias(f"missing_{c}") for c in "ghn"),
        *(F.sum(F.when(present, F.col(c))).over(upward).alias(f"below_{c}") for c in "ghn"),
    ).where(present)
    sides = sums.withColumn("missing_left", F.explode(F.array(F.lit(True), F.lit(False))))
    left = {c: F.col(f"below_{c}") + F.when(F.col("missing_left"), F.col(f"missing_{c}")).otherwise(0) for c in "ghn"}
    right = {c: F.col(f"all_{c}") - left[c] for c in "ghn"}
    sides = sides.select(*HISTOGRAM, "missing_left", *(left[c].alias(f"left_{c}") for c in "ghn"), *(right[c].alias(f"right_{c}") for c in "ghn"))

    def quality(g: Column, h: Column) -> Column:
        g, h = g / FIXED_POINT, h / FIXED_POINT
        return g * g / (h + params.l2)

    lg, lh, rg, rh = (F.col(c) for c in ("left_g", "left_h", "right_g", "right_h"))
    gain = (quality(lg, lh) + quality(rg, rh) - quality(lg + rg, lh + rh)) / 2
    least = params.min_child_weight * FIXED_POINT
    able = sides.withColumn("gain", gain).where((F.col("left_n") > 0) & (F.col("right_n") > 0) & (lh >= least) & (rh >= least) & (F.col("gain") > params.min_gain + NOISE))
    names = ["feature", "bin", "missing_left", "gain", "left_g", "left_h", "right_g", "right_h"]
    rank = F.struct("gain", -F.col("feature"), -F.col("bin"), "missing_left")
    return able.groupBy("node").agg(F.max_by(F.struct(*names), rank).alias("best")).select("node", "best.*")


def weight(g: int, h: int, params: Params) -> float:
    """The value of a leaf with these sums."""
    return -params.learning_rate * (g / FIXED_POINT) / (h / FIXED_POINT + params.l2)


def surpassing(gains: dict[int, float], most: int) -> set[int]:
    """The splits that taking the greatest gain first would make: the `most` with the greatest least gain from the root on."""
    least: dict[int, float] = {}
    for node in sorted(gains):
        above = math.inf if node == 0 else least.get((node - 1) // 2)
        if above is not None:
            least[node] = min(above, gains[node])
    return set(sorted(least, key=lambda n: (-least[n], n))[:most])


def grown(rows: DataFrame, margin: Column, edges: list[list[float]], params: Params) -> Tree:
    """One tree from rows of bins and labels, an aggregation a level."""
    tree = Tree()
    sums: dict[int, tuple[int, int]] = {}
    frontier = {0}
    for _ in range(params.max_depth):
        if not frontier:
            break
        node = F.expr(tree.sql(goes_left, lambda n: f"{n}L" if n in frontier else "CAST(NULL AS BIGINT)"))
        found = best_splits(histogram(rows, node, margin, len(edges)), params).collect()  # one row a node
        for r in found:
            e = edges[r["feature"]]
            tree.splits[r["node"]] = Split(r["feature"], r["bin"], e[r["bin"] - 1] if r["bin"] <= len(e) else None, r["missing_left"], r["gain"])
            sums[2 * r["node"] + 1] = r["left_g"], r["left_h"]
            sums[2 * r["node"] + 2] = r["right_g"], r["right_h"]
        if params.growth == "leaf":
            stay = surpassing({n: s.gain for n, s in tree.splits.items()}, params.leaves - 1)
            tree.splits = {n: s for n, s in tree.splits.items() if n in stay}
        frontier = {c for r in found if r["node"] in tree.splits for c in (2 * r["node"] + 1, 2 * r["node"] + 2)}
    if not tree.splits:
        return tree
    ends = [c for n in tree.splits for c in (2 * n + 1, 2 * n + 2) if c not in tree.splits]
    tree.values = {c: weight(*sums[c], params) for c in ends}
    return tree


@dataclass
class BoostedModel:
    """Trees over named inputs; scoring is one expression, without functions outside the JVM."""

    inputs: list[str]
    base: float
    trees: list[Tree]
    params: Params

    def margin(self) -> Column:
        def test(split: Split) -> str:
            x = f"nanvl(CAST(`{self.inputs[split.feature].replace('`', '``')}` AS DOUBLE), NULL)"
            below = f"{x} IS NOT NULL" if split.threshold is None else f"{x} < {split.threshold!r}D"
            return f"({x} IS NULL OR {below})" if split.missing_left else f"coalesce({below}, false)"

        total = F.lit(self.base)
        for tree in self.trees:
            total = total + F.expr(tree.sql(test, tree.value))
        return total

    def risk(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"inputs": self.inputs, "base": self.base, "params": asdict(self.params), "trees": [
            {"splits": {str(n): asdict(s) for n, s in t.splits.items()}, "values": {str(n): v for n, v in t.values.items()}} for t in self.trees]})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        m = json.loads(spark.read.text(path, wholetext=True).first()[0])
        trees = [Tree({int(n): Split(**s) for n, s in t["splits"].items()}, {int(n): v for n, v in t["values"].items()}) for t in m["trees"]]
        return cls(m["inputs"], m["base"], trees, Params(**m["params"]))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit(rows: DataFrame, inputs: list[str], label: str, params: Params) -> BoostedModel:
    """A model for a label of 0 and 1; rows without a label are left out, missing inputs are learned from.

    Without rows, or with labels of one kind, there are no trees and every risk is that share of ones.
    """
    labelled = rows.where(F.col(label).isNotNull())
    edges = quantile_edges(labelled, inputs, params.bins)
    held = stored(binned(labelled, inputs, edges, label), "boosting-rows")
    count = held.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")).first()
    share = (count["ones"] or 0) / count["n"] if count["n"] else 0.0
    if not 0 < share < 1:
        return BoostedModel(inputs, 40.0 if share else -40.0, [], params)
    base = math.log(share / (1 - share))
    held = held.withColumn("margin", F.lit(base))
    trees: list[Tree] = []
    recent: list[Tree] = []

    def now() -> Column:
        total = F.col("margin")
        for t in recent:
            total = total + F.expr(t.sql(goes_left, t.value))
        return total

    while len(trees) < params.trees:
        tree = grown(held, now(), edges, params)
        if not tree.splits:
            break
        trees.append(tree)
        recent.append(tree)
        if len(recent) == params.store_every and len(trees) < params.trees:
            held = stored(held.withColumn("margin", now()), "boosting-rows")
            recent.clear()
    return BoostedModel(inputs, base, trees, params)
