"""Risk model: training (M3), metrics (M4), registry (M5, W7, T1), batch scoring (M6), heat map (M7)."""

from __future__ import annotations

import json
import re
from dataclasses import asdict

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexwatch.functions.hexcover import in_box_by_cell, parent_cell
from hexwatch.functions.hexgrid import with_ring
from hexwatch.functions.metrics_json import metrics_map
from hexwatch.operators import boosting
from hexwatch.operators.boosting import BoostedModel
from hexwatch.operators.clean import filter_region
from hexwatch.settings import H3_RESOLUTION, Box

INPUTS = [
    "hour_of_day", "day_of_week", "is_weekend", "is_night", "is_holiday", "month", "season",
    "crimes_last_1h", "crimes_last_24h", "crimes_last_7d", "same_hour_last_week", "rolling_avg_30d",
]
#: Second-order boosting by name: how its trees grow.
GROWTH = {"xgboost": "level", "lightgbm": "leaf"}
#: Spark's names of the same parameters; there is nothing random to seed.
SPARK_NAMES = {"maxIter": "trees", "maxDepth": "max_depth", "stepSize": "learning_rate", "maxBins": "bins"}
REGISTRY_SCHEMA = (
    "model_id string, version string, model_type string, trained_at timestamp, artifact_path string, "
    "is_active boolean, metrics map<string,double>, training_samples bigint, feature_count int, "
    "training_duration_seconds decimal(10,2), hyperparameters string, write_seq bigint"
)


def split_by_time(features: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Train before the cutoff, test from it on: a random split would leak look-back counts."""
    return features.where(F.col("time_window") < cutoff), features.where(F.col("time_window") >= cutoff)


def is_complete() -> Column:
    """Whether all inputs of the model are known."""
    test = F.lit(True)
    for c in INPUTS:
        test &= F.col(c).isNotNull()
    return test


def training_rows(features: DataFrame) -> DataFrame:
    """The rows that a model learns from: those with a target and all inputs."""
    return features.where(F.col("target_binary").isNotNull() & is_complete())


def train(features: DataFrame, model_type: str = "logistic_regression", **params) -> PipelineModel | BoostedModel:
    """M3. `logistic_regression` and `gbt` are Spark's and learn from `training_rows`; `xgboost` and `lightgbm` boost with second
    derivatives over binned inputs, level by level or leaf by leaf (see `boosting.Params`), and learn from missing inputs too."""
    if model_type in GROWTH:
        own = {SPARK_NAMES.get(k, k): v for k, v in params.items() if k != "seed"}
        return boosting.fit(features, INPUTS, "target_binary", boosting.Params(GROWTH[model_type], **own))
    common = dict(featuresCol="features", labelCol="target_binary")
    if model_type == "logistic_regression":
        classifier = LogisticRegression(**common, **params)
    elif model_type == "gbt":
        classifier = GBTClassifier(**common, **params)
    else:
        raise ValueError(f"unknown model type {model_type!r}")
    assembler = VectorAssembler(inputCols=INPUTS, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, classifier]).fit(training_rows(features))


def score(model: PipelineModel | BoostedModel, features: DataFrame) -> DataFrame:
    """M6: the probability of an event per (cell, hour); every row stays. Boosted trees score rows with missing inputs, the other
    models give them no risk."""
    if isinstance(model, BoostedModel):
        return features.withColumn("risk", model.risk())
    scored = model.transform(features).withColumn("risk", F.when(is_complete(), vector_to_array("probability")[1]))
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def score_counts(scored: DataFrame, label: str = "target_binary", risk: str = "risk") -> DataFrame:
    """Positive and negative rows per distinct score: all that the metrics need of the scored rows, in one pass."""
    positive = F.count_if(F.col(label) == 1)
    return scored.where(F.col(risk).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(risk).cast("double").alias("score")).agg(
        positive.alias("pos"), (F.count(F.lit(1)) - positive).alias("neg"))


def score_splits(counts: DataFrame, per_range: int = 500_000) -> list[float]:
    """Split points between ranges of about `per_range` distinct scores each: the only numbers of the metric computation
    that reach the driver. The ranges grow in number with the scores, not in size."""
    ranges = 1 + counts.count() // per_range
    if ranges < 2:
        return []
    points = counts.agg(F.percentile_approx("score", [i / ranges for i in range(1, ranges)], 10_000)).first()[0]
    return sorted(set(points or []))


def curve_areas(counts: DataFrame, splits: list[float]) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve (trapezoids over distinct scores), from `score_counts`.

    The running totals are taken inside score ranges, each a window partition of its own, on top of the totals of all higher
    ranges, a table as long as the list of split points. No task sees all scores, and the split points only balance the
    work: any of them give the same result.
    """
    edges = [float("-inf"), *splits, float("inf")]
    ranged = (
        Bucketizer(splits=edges, inputCol="score", outputCol="range").transform(counts)
        if len(edges) > 2 else counts.withColumn("range", F.lit(0.0))
    )
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy("range").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).select(
        "range",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("base_pos"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("base_neg"),
    )
    downward = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    tp, fp = F.col("tp"), F.col("fp")
    pos, neg = F.col("pos"), F.col("neg")
    curve = ranged.join(F.broadcast(bases), "range").select(  # one row per range
        "pos", "neg",
        (F.col("base_pos") + F.sum("pos").over(downward)).alias("tp"),
        (F.col("base_neg") + F.sum("neg").over(downward)).alias("fp"),
    )
    precision = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp - pos, tp - pos + fp - neg), precision)
    sums = curve.agg(
        F.sum(neg * (tp - pos / 2)).alias("roc"), F.sum(pos * (before + precision) / 2).alias("pr"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
    )
    return sums.select(
        F.try_divide(F.col("roc"), F.col("p").cast("double") * F.col("n")).alias("roc_auc"),
        F.try_divide(F.col("pr"), F.col("p")).alias("pr_auc"),
    )


def threshold_metrics(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Brier score, precision, recall and F1, from `score_counts`."""
    pos, neg, p = F.col("pos"), F.col("neg"), F.col("score")
    hit = p >= threshold
    square = F.sum(pos * F.pow(p - 1, F.lit(2)) + neg * F.pow(p, F.lit(2)))
    sums = counts.agg(
        F.try_divide(square, F.sum(pos + neg)).alias("brier_score"),
        F.coalesce(F.sum(F.when(hit, pos)), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.when(hit, neg)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~hit, pos)), F.lit(0)).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        "brier_score",
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def evaluate(scored: DataFrame, path: str, threshold: float = 0.5) -> DataFrame:
    """M4: one row with all six metrics and the same as a map.

    The counts per score are written to `path` (a shared folder) and read from there, so the scored rows, and the model and
    features behind them, are computed once.
    """
    score_counts(scored).write.mode("overwrite").parquet(path)
    counts = scored.sparkSession.read.schema("score double, pos bigint, neg bigint").parquet(path)
    areas = curve_areas(counts, score_splits(counts))
    # Both sides are single rows from global aggregates.
    both = areas.withColumn("_one", F.lit(1)).join(threshold_metrics(counts, threshold).withColumn("_one", F.lit(1)), "_one")
    row = both.drop("_one")
    return row.withColumn("metrics", metrics_map(**{c: F.col(c) for c in row.columns}))


def registry_entry(
    model: PipelineModel | BoostedModel, features: DataFrame, metrics: DataFrame, path: str, model_id: str, version: str, model_type: str,
    trained_at: Column, seconds: float, write_seq: int, is_active: bool = True,
) -> DataFrame:
    """M5: save a fitted model under `path` and describe it as one registry row: metrics from `evaluate`, the number of rows it
    learned from, its inputs, and its parameters as JSON."""
    if isinstance(model, BoostedModel):
        model.save(features.sparkSession, path)
        chosen, learned = asdict(model.params), features.where(F.col("target_binary").isNotNull())
    else:
        model.write().overwrite().save(path)
        chosen = {p.name: v for p, v in model.stages[-1].extractParamMap().items() if isinstance(v, (bool, int, float, str))}
        learned = training_rows(features)
    kinds = dict(part.strip().split(" ", 1) for part in re.split(r", (?=\w+ )", REGISTRY_SCHEMA))
    values = {
        "model_id": F.lit(model_id), "version": F.lit(version), "model_type": F.lit(model_type), "trained_at": trained_at, "artifact_path": F.lit(path),
        "is_active": F.lit(is_active), "metrics": F.col("metrics"), "training_samples": F.lit(learned.count()), "feature_count": F.lit(len(INPUTS)),
        "training_duration_seconds": F.lit(seconds), "hyperparameters": F.lit(json.dumps(chosen, sort_keys=True)), "write_seq": F.lit(write_seq),
    }
    return metrics.select(*(values[c].cast(t).alias(c) for c, t in kinds.items()))


def load_model(entry_path: str, model_type: str = "logistic_regression") -> PipelineModel | BoostedModel:
    """M5: the model that a registry row's `artifact_path` and `model_type` name."""
    if model_type in GROWTH:
        return BoostedModel.load(SparkSession.active(), entry_path)
    return PipelineModel.load(entry_path)


def current_models(writes: DataFrame) -> DataFrame:
    """Upsert fold: the last written row of each model id."""
    newest = writes.groupBy("model_id").agg(
        F.max_by(F.struct(*[c for c in writes.columns if c != "model_id"]), "write_seq").alias("_row")
    )
    return newest.select("model_id", "_row.*").select(*writes.columns)


def single_active(models: DataFrame) -> DataFrame:
    """Of the rows marked active only the one written last stays active. The deciding number is a scalar
    subquery, so rows are neither sorted nor brought together."""
    last = models.where("is_active").agg(F.max("write_seq")).scalar()
    return models.withColumn("is_active", F.coalesce(F.col("is_active") & (F.col("write_seq") == last), F.lit(False)))


def register_model(models: DataFrame, entry: DataFrame) -> DataFrame:
    """M5: add or replace a model and re-establish the single active one."""
    return single_active(current_models(models.unionByName(entry)))


def latest_model(models: DataFrame) -> DataFrame:
    """A top-1 plan; of equal times the greatest model id."""
    return models.where("is_active").orderBy(F.desc("trained_at"), F.desc("model_id")).limit(1)


def _in_box(gold: DataFrame, box: Box, by_cell: bool) -> DataFrame:
    return gold.where(in_box_by_cell(box)) if by_cell else filter_region(gold, box=box)


def heatmap_counts(gold: DataFrame, box: Box, start: Column, end: Column, by_cell: bool = False, res: int = H3_RESOLUTION) -> DataFrame:
    """M7 over events: incidents per cell in a box and period (end exclusive).

    `by_cell` asks for the box by ranges of cell ids as well, which lets the scan of the stored table skip most of it; the rows
    are the same. A coarser `res` rolls cells up.
    """
    inside = _in_box(gold, box, by_cell).where((F.col("occurred_at") >= start) & (F.col("occurred_at") < end))
    cell = F.col("h3_index") if res == H3_RESOLUTION else parent_cell(F.col("h3_index"), res)
    return inside.groupBy(cell.alias("h3_index")).agg(F.count(F.lit(1)).alias("crime_count"))


def heatmap_smoothed(counts: DataFrame, res: int = H3_RESOLUTION) -> DataFrame:
    """M7 over counts per cell (`h3_index`, `crime_count`): the incidents in each cell with some and in the ring around it. Every count goes
    to its seven cells before the one exchange; nothing is joined."""
    spread = with_ring(counts.select("h3_index", "crime_count"), res=res, own=True)
    mine = F.sum(F.when(F.col("ring_cell") == F.col("h3_index"), F.col("crime_count"))).alias("crime_count")
    summed = spread.where("ring_cell is not null").groupBy("ring_cell").agg(mine, F.sum("crime_count").alias("with_ring"))
    return summed.where("crime_count is not null").select(F.col("ring_cell").alias("h3_index"), "crime_count", "with_ring")


def heatmap_risk(scored: DataFrame, gold: DataFrame, box: Box, start: Column, end: Column, by_cell: bool = False) -> DataFrame:
    """M7 over risk: mean risk per cell that has incidents in the box."""
    cells = _in_box(gold, box, by_cell).select("h3_index").distinct()
    inside = scored.where((F.col("time_window") >= start) & (F.col("time_window") < end))
    return inside.join(cells, "h3_index", "left_semi").groupBy("h3_index").agg(F.avg("risk").alias("mean_risk"))
