"""Metrics map <-> JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys of a model's metrics.
METRIC_KEYS = ["roc_auc", "pr_auc", "brier_score", "precision", "recall", "f1_score"]


def read_metrics(c: Column) -> Column:
    return F.from_json(c, "map<string,double>")


def write_metrics(c: Column) -> Column:
    return F.to_json(c)


def metrics_map(**values: Column) -> Column:
    """Map in the fixed key order; a metric that was not computed is left out."""
    pairs = [p for k in METRIC_KEYS if k in values for p in (F.lit(k), values[k].cast("double"))]
    return F.create_map(*pairs)
