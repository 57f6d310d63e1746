import random

import pytest
from pyspark.sql import functions as F

from hexwatch.functions import hexcover as C
from hexwatch.functions.hexgrid import with_h3
from hexwatch.operators.clean import filter_region
from hexwatch.operators.model import heatmap_counts
from hexwatch.settings import Box

BOXES = [Box(43.6, 43.7, -79.5, -79.3), Box(43.65, 43.66, -79.40, -79.38), Box(43.5, 43.9, -79.8, -79.0), Box(43.7, 43.7, -79.4, -79.4), Box(43.58, 43.88, -79.41, -79.40)]


@pytest.fixture(scope="module")
def points(spark, tmp_path_factory):
    """Points all over the region, stored in order of their cells in many row groups."""
    grid = spark.range(400 * 400).select((F.lit(43.5) + (F.col("id") % 400) / 1000.0).alias("latitude"), (F.lit(-79.8) + F.floor(F.col("id") / 400) / 500.0).alias("longitude"))
    path = str(tmp_path_factory.mktemp("points") / "p")
    with_h3(grid).orderBy("h3_index").coalesce(1).write.option("parquet.block.size", 16384).parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("options", [{}, {"max_cells": 20, "max_ranges": 3}, {"max_ranges": 1}])
def test_the_same_rows(points, box, options):
    expected = filter_region(points, box=box)
    found = points.where(C.in_box_by_cell(box, **options))
    assert found.count() == expected.count() and expected.exceptAll(found).isEmpty()
    assert len(C.id_ranges(box, **options)) <= options.get("max_ranges", C.MAX_RANGES)


@pytest.mark.parametrize("box", BOXES[:1])
def test_inner_cells_hold_no_other_rows(points, box):
    inner = [digits for digits, inside in C.cover(box) if inside]
    assert len({len(digits) for digits in inner}) > 1  # cells of several resolutions
    test = F.lit(False)
    for digits in inner:
        number, size = sum(d * 7 ** (len(digits) - 1 - k) for k, d in enumerate(digits)), 7 ** (9 - len(digits))
        test = test | F.col("h3_index").between(C.id_of(number * size, 9), C.id_of((number + 1) * size - 1, 9))
    own = points.where(test)
    assert own.count() == filter_region(own, box=box).count() > 0


def scanned(df):
    """Rows that the file scan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = (plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan).collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_ranges_reach_the_scan(spark, points):
    box = BOXES[1]
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    found = points.where(C.in_box_by_cell(box))
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(h3_index" in plan and "LessThanOrEqual(h3_index" in plan
    by_cell, by_coordinates, everything = scanned(found), scanned(filter_region(points, box=box)), points.count()
    print("scanned", by_cell, by_coordinates, everything, found.count())
    assert 0 < by_cell < 0.05 * everything and by_cell <= by_coordinates


def test_heatmap_by_cell(points):
    rows = points.withColumn("occurred_at", F.lit("2024-01-05").cast("timestamp"))
    args = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    for box in BOXES:
        a, b = heatmap_counts(rows, box, *args), heatmap_counts(rows, box, *args, by_cell=True)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_parents_and_centres(points, spark):
    # The base-7 number and the id tell the same digits, and each parent is the one of its own child.
    rng = random.Random(3)
    ids = [C.id_of(rng.randrange(7**9), 9) for _ in range(200)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "h string")
    rows = df.select("h", *(C.parent_cell(F.col("h"), r).alias(f"p{r}") for r in range(10))).collect()
    for r in rows[:-1]:
        bits = int(r["h"], 16)
        digits = [bits >> 3 * (15 - k) & 7 for k in range(1, 10)]
        for res in range(10):
            number = 0
            for d in digits[:res]:
                number = number * 7 + d
            assert r[f"p{res}"] == C.id_of(number, res)
        assert r["p9"] == r["h"]
    assert all(v is None for v in rows[-1])
    with pytest.raises(ValueError):
        C.parent_cell(F.col("h"), 10)


def test_centres_lie_in_their_cells(points):
    """Walking down by digits leads to the cell whose id has them."""
    for row in points.where("rand(5) < 0.001").limit(60).collect():
        bits = int(row["h3_index"], 16)
        a, b = C.BASE_AXIAL
        for k in range(1, 10):
            d, a, b = next(c for c in C.children(a, b, k) if c[0] == bits >> 3 * (15 - k) & 7)
        (x, y), (px, py) = C.centre(a, b, 9), C.on_plane(row["latitude"], row["longitude"])
        assert ((x - px) ** 2 + (y - py) ** 2) ** 0.5 <= C.UNIT_STEP / C.ROOT7**9 / 3**0.5 * 1.001
