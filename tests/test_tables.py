"""Ledger, checks, features and models against brute force on small frames."""

import datetime as dt
import random

import pytest
from tests.helpers import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from hexwatch.functions import times
from hexwatch.operators import features, joins, ledger, model, quality
from hexwatch.session import shared_dir
from hexwatch.settings import SILVER_SCHEMA

T0 = dt.datetime(2024, 1, 1)


def fold_by_hand(events):
    table = {}
    for e in sorted(events, key=lambda e: e["seq"]):
        row = table.get(e["file_name"])
        if e["kind"] == "start":
            if row is None:
                row = table[e["file_name"]] = dict(last_timestamp=None, error_message=None, dataset_type=None)
            row.update(status="in_progress", ingested_at=e["at"], record_count=e["record_count"],
                       dataset_type=e["dataset_type"] or row["dataset_type"])
        elif row is not None and e["kind"] == "fail":
            row.update(status="failed", error_message=e["error_message"][:1000])
        elif row is not None:
            row.update(status="completed", record_count=e["record_count"], last_timestamp=e["last_timestamp"], error_message=None)
            if e["kind"] == "complete":
                row["dataset_type"] = e["dataset_type"] or row["dataset_type"]
    return table


def test_ledger_fold(spark):
    rng = random.Random(5)
    events = [
        dict(file_name=f"f{rng.randrange(60)}", kind=rng.choice(["start", "complete", "fail", "gold_complete"]), seq=i,
             at=T0 + dt.timedelta(minutes=i), record_count=rng.randrange(9),
             last_timestamp=rng.choice([None, T0 + dt.timedelta(days=i)]), error_message="e" * rng.choice([3, 1500]),
             dataset_type=rng.choice([None, "x", "y"]))
        for i in range(300)
    ]
    df = spark.createDataFrame(events, ledger.EVENT_SCHEMA)
    want = fold_by_hand(events)
    got = {r.file_name: {k: v for k, v in r.asDict().items() if k != "file_name"} for r in ledger.fold(df).collect()}
    assert got == want
    assert [r.ingested_at for r in ledger.last_ingested(ledger.fold(df), 3).collect()] == sorted(
        (r["ingested_at"] for r in want.values()), reverse=True)[:3]


def test_unseen_files_and_status(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file_name string")
    seen = spark.createDataFrame([("a", "completed"), ("b", "failed")], "file_name string, status string")
    assert rows(joins.unseen_files(files, seen)) == [("c",)]
    assert sorted(rows(joins.unseen_files(files, seen, retry_failed=True))) == [("b",), ("c",)]


def test_empty_tables_in_checks(spark):
    empty = spark.createDataFrame([], SILVER_SCHEMA)
    assert all(r.passed for r in quality.verify_silver(empty).collect())
    gold = empty.withColumns({"h3_index": F.lit("x"), "geom": F.lit("x")})
    assert not any(r.passed for r in quality.verify_gold(gold).collect())


def test_structure_stops_the_other_checks(spark):
    raw = spark.createDataFrame([("43.2", None, "f")], "lat string, long string, source_file string")
    assert {r.check for r in quality.validate_raw(raw).collect() if not r.passed and r.level == "error"} == {
        "has occurrence_date", "has major_crime_indicator"}
    sound = raw.withColumns({"Occurrence Date": F.lit("x"), "offence": F.lit("y")})
    got = {r.check: (r.passed, r.value) for r in quality.validate_raw(sound).collect()}
    assert got["lat in range"] == (True, 0.0) and got["long in range"] == (False, 1.0)
    assert got["long mostly present"] == (False, 100.0)
    report = quality.file_profile(sound).first()
    assert (report.row_count, report.column_count, report.is_valid, report.errors) == (1, 4, False, 1)


def counts_frame(spark):
    rng = random.Random(1)
    data = {(f"c{rng.randrange(3)}", 470_000 + rng.randrange(1600)): rng.randrange(1, 5) for _ in range(400)}
    return data, spark.createDataFrame([(c, h, n) for (c, h), n in data.items()], "h3_index string, hour_no bigint, crime_count bigint")


def test_lookbacks_dense_and_sparse(spark):
    data, counts = counts_frame(spark)

    def total(cell, hour, low, high):
        return sum(data.get((cell, hour + d), 0) for d in range(low, high + 1))

    dense = features.with_lookbacks(features.densify(counts))
    sparse = features.with_lookbacks(counts)
    for frame in (dense, sparse):
        for r in frame.collect():
            assert r.crime_count == data.get((r.h3_index, r.hour_no), 0)
            for name, (low, high) in features.LOOKBACKS.items():
                assert r[name] == total(r.h3_index, r.hour_no, low, high)
            assert abs(float(r.rolling_avg_30d) - total(r.h3_index, r.hour_no, -720, -1) / 720) <= 0.00005
    spans = {c: [h for k, h in data if k == c] for c in {k for k, _ in data}}
    assert dense.count() == sum(max(s) - min(s) + 1 for s in spans.values())
    hours = [h for _, h in data]
    table = features.densify(counts, "table")
    assert table.count() == len(spans) * (max(hours) - min(hours) + 1)
    wide = features.densify(counts, start=F.lit(min(hours) - 5), end=F.lit(max(hours) + 7))
    assert wide.count() == len(spans) * (max(hours) - min(hours) + 13)
    assert wide.select(F.sum("crime_count")).first()[0] == sum(data.values())


def test_gap_filling_and_lookbacks_share_one_exchange(spark):
    _, counts = counts_frame(spark)
    frame = features.with_lookbacks(features.densify(counts))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def scored_frame(spark, n=3000):
    rng = random.Random(2)
    data = [(rng.choice([0.5, round(rng.random(), 3), rng.random() ** 9]), int(rng.random() < 0.3)) for _ in range(n)]
    return spark.createDataFrame(data, "risk double, target_binary int")


@pytest.mark.parametrize("per_range", [10, 300, 10**6])
def test_curve_areas_are_exact_for_any_split(spark, per_range):
    df = scored_frame(spark)
    counts = model.score_counts(df)
    got = model.curve_areas(counts, model.score_splits(counts, per_range)).first()
    for metric, value in (("areaUnderROC", got.roc_auc), ("areaUnderPR", got.pr_auc)):
        judge = BinaryClassificationEvaluator(
            rawPredictionCol="risk", labelCol="target_binary", metricName=metric, numBins=0)
        assert abs(judge.evaluate(df) - value) < 1e-9


def test_single_active_model(spark):
    data = [("a", True, 1), ("b", True, 2), ("b", False, 4), ("c", True, 3), ("d", None, 5)]
    models = spark.createDataFrame(data, "model_id string, is_active boolean, write_seq bigint")
    got = {r.model_id: r.is_active for r in model.register_model(models.limit(0), models).collect()}
    assert got == {"a": False, "b": False, "c": True, "d": False}


def test_training_and_scoring(spark):
    rng = random.Random(3)
    gold = spark.createDataFrame(
        [(f"cell{rng.choice([0, 0, 0, 1, 2])}", T0 + dt.timedelta(hours=rng.randrange(400))) for _ in range(500)],
        "h3_index string, occurred_at timestamp")
    feats = features.build_features(gold).cache()
    before, after = model.split_by_time(feats, F.lit("2024-01-12").cast("timestamp"))
    for kind, params in (("logistic_regression", {"maxIter": 5}), ("xgboost", {"maxIter": 2, "maxDepth": 2})):
        scored = model.score(model.train(before, kind, **params), after)
        assert scored.where("risk between 0 and 1").count() == after.count()
        assert set(model.evaluate(scored, shared_dir(spark, "scores")).first().metrics) == {
            "roc_auc", "pr_auc", "brier_score", "precision", "recall", "f1_score"} 
    with pytest.raises(ValueError):
        model.train(before, "forest")


def test_counted_small_sides_leave_the_big_side_in_place(spark):
    """Also where Spark itself would not broadcast: J1, J3, J4 and F15 move their small side only."""
    big = spark.range(1000).select(
        F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("source_file"), F.lit(None).cast("string").alias("dataset_type"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("time_window"))
    known = spark.createDataFrame([("f1", "t")], "source_file string, dataset_type string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entries = known.withColumnRenamed("source_file", "file_name")
        days = spark.createDataFrame([(T0.date(),)], "holiday_date date")
        for df, rows in ((joins.drop_loaded(big, known), 667), (joins.backfill_dataset_type(big, entries), 1000), (times.with_holiday_flag(big, days), 1000)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
            assert df.count() == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_without_an_input_stay_and_have_no_risk(spark):
    rng = random.Random(5)
    gold = spark.createDataFrame(
        [(f"cell{rng.choice([0, 0, 1])}", T0 + dt.timedelta(hours=rng.randrange(200))) for _ in range(300)], "h3_index string, occurred_at timestamp")
    feats = features.build_features(gold).withColumn("crimes_last_7d", F.when(F.hour("time_window") != 3, F.col("crimes_last_7d")))
    scored = model.score(model.train(feats, maxIter=3), feats)
    assert scored.count() == feats.count()
    assert scored.where("risk is null").count() == feats.where("crimes_last_7d is null").count() > 0
