"""Keys over loads against sets; distinct counts over loads against the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tests.test_sources import HEADER

from hexwatch.operators import aggregates, keyindex, sketches
from hexwatch.session import shared_dir
from hexwatch.settings import GOLD_SCHEMA, RAW_KEY
from hexwatch.sources.gold import scan_gold, write_gold
from hexwatch.streaming.arrivals import load_files


def keyed(spark, keys, file):
    return spark.createDataFrame([(k, file) for k in keys], f"{RAW_KEY} string, source_file string")


def test_first_load_wins(spark):
    """Against sets: loads of several files, missing keys, empty keys, corrected files, a load without rows."""
    rng, path = random.Random(1), shared_dir(spark, "keys")
    held = {}  # file -> keys it owns
    for step in range(8):
        file = rng.choice("abc")
        keys = {rng.choice([None, "", f"k{rng.randrange(40)}"]) for _ in range(rng.choice([0, 20, 30]))}
        load = keyed(spark, sorted(keys, key=repr), file)
        kept = keyindex.drop_known(load, path, [file])
        want = {k for k in keys if not any(k in owned for f, owned in held.items() if f != file)}
        got = {r[0] for r in kept.collect()}
        assert got == want, step
        keyindex.add_keys(keyed(spark, sorted(want, key=repr), file), path, [file])
        held[file] = want


def test_filters_leave_few_keys_to_compare(spark):
    path = shared_dir(spark, "keys")
    numbers = lambda low, high: spark.range(low, high).select(F.col("id").cast("string").alias(RAW_KEY), F.lit(f"f{low}").alias("source_file"))
    for low in range(0, 30_000, 10_000):
        keyindex.add_keys(numbers(low, low + 10_000), path, [f"f{low}"])
    levels = rows(keyindex.merged_filters(spark, path).groupBy("level").count().orderBy("level"))
    assert [n for n, _ in levels] == sorted({keyindex.level_for(n) for n in (10_000, 20_000, 30_000)})
    new = numbers(29_000, 129_000)
    hits = keyindex.possible_hits(new.select(F.col(RAW_KEY).alias("key")), path).count()
    assert 1000 <= hits <= 1000 + 0.02 * 99_000
    left = keyindex.drop_known(new, path, ["new"])
    assert left.count() == 99_000
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_copies_in_a_later_load(spark, tmp_path):
    base = shared_dir(spark, "across-loads")
    first, second = "major-crime-indicators_20240101_000000.csv", "assault_20240102_000000.csv"
    row = "{},2024-01-01,5,43.70,-79.40,Assault,x,y"
    (tmp_path / first).write_text("\n".join([HEADER, row.format("E1"), row.format("E2"), "E3,2024-01-01,5,0,0,Assault,x,y"]) + "\n")
    (tmp_path / second).write_text("\n".join([HEADER, *(row.format(k) for k in ("E2", "E3", "E4"))]) + "\n")

    def load(*names):
        load_files(spark, [str(tmp_path / n) for n in names], f"{base}/gold", f"{base}/ledger", key_index=f"{base}/keys")
        return {r.source_file: r.record_count for r in aggregates.file_load_stats(scan_gold(spark, f"{base}/gold")).collect()}

    assert load(first) == {first: 2}
    # E3's first copy lies outside the region: it decides all the same.
    assert load(second) == {first: 2, second: 1}
    # Loading a file again neither meets its own keys nor takes those of the other.
    assert load(first) == {first: 2, second: 1}
    assert load(second) == {first: 2, second: 1}
    # After a correction the first file no longer holds E2.
    (tmp_path / first).write_text("\n".join([HEADER, row.format("E1")]) + "\n")
    assert load(first) == {first: 1, second: 1}
    assert load(second) == {first: 1, second: 3}


def gold_rows(spark, cells, file, dataset):
    made = spark.createDataFrame([(c, file, dataset) for c in cells], "h3_index string, source_file string, dataset_type string")
    return made.withColumn("occurred_at", F.lit("2024-01-01 05:10:00").cast("timestamp"))


def test_sketches_follow_the_loads(spark):
    base = shared_dir(spark, "sketches")
    gold, kept = f"{base}/gold", f"{base}/sketches"

    def counts(*keys):
        sketches.update(spark, gold, kept)
        return sorted(rows(sketches.distinct_counts(sketches.current(spark, gold, kept), *keys)), key=repr)

    empty = spark.createDataFrame([], GOLD_SCHEMA)

    def load(cells, file, dataset):
        made = gold_rows(spark, cells, file, dataset)
        write_gold(empty.unionByName(made, allowMissingColumns=True), gold, files=[file])

    assert counts() == [(0, 0, 0)]
    load(["a", "b", "b"], "f1", "x")
    load(["b", "c"], "f2", "y")
    assert counts() == [(5, 3, 3)] and counts("dataset_type") == [("x", 3, 2, 2), ("y", 2, 2, 2)]
    assert rows(sketches.shared_cells(sketches.current(spark, gold, kept), "x", "y")) == [(1, 3)]
    load(["c", "d", "e"], "f1", "x")  # a correction
    assert counts() == [(5, 4, 4)]
    assert rows(sketches.shared_cells(sketches.current(spark, gold, kept), "x", "y")) == [(1, 4)]
    assert rows(sketches.shared_cells(sketches.current(spark, gold, kept), "x", "none")) == [(0, 3)]
    load([], "f2", "y")
    assert counts() == [(3, 3, 3)]


def test_sketch_error(spark):
    base = shared_dir(spark, "sketch-error")
    for k in range(2):
        made = spark.range(60_000).select(F.concat(F.lit("c"), F.col("id") + k * 30_000).alias("h3_index")).withColumns({
            "source_file": F.lit(f"f{k}"), "dataset_type": F.lit("xy"[k]), "occurred_at": F.lit("2024-01-01").cast("timestamp")})
        write_gold(spark.createDataFrame([], GOLD_SCHEMA).unionByName(made, allowMissingColumns=True), f"{base}/gold")
    sketches.update(spark, f"{base}/gold", f"{base}/sketches")
    current = sketches.current(spark, f"{base}/gold", f"{base}/sketches")
    got = sketches.distinct_counts(current).first()
    assert got.crime_count == 120_000 and got.distinct_cells == pytest.approx(90_000, rel=4 * sketches.ERROR)
    shared, union = sketches.shared_cells(current, "x", "y").first()
    assert shared == pytest.approx(30_000, abs=4 * sketches.ERROR * 90_000) and union == pytest.approx(90_000, rel=4 * sketches.ERROR)
