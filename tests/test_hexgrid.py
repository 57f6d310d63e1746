import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hexwatch.functions import hexgrid
from hexwatch.functions.hexgrid import BASE_CELL, FACE_AXIS_AZIMUTH, FACE_LAT, FACE_LON, ODD_ROTATION, UNIT_STEP, with_h3

AXES = np.array([(1.0, 0.0), (-0.5, math.sqrt(3) / 2), (-0.5, -math.sqrt(3) / 2)])
DIGIT_IJK = [(0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 1, 1), (1, 0, 0), (1, 0, 1), (1, 1, 0)]


def to_plane(lat, lon, res):
    phi, lam = np.radians(lat), np.radians(lon) - FACE_LON
    r = np.arccos(np.sin(FACE_LAT) * np.sin(phi) + np.cos(FACE_LAT) * np.cos(phi) * np.cos(lam))
    az = np.arctan2(np.cos(phi) * np.sin(lam), np.cos(FACE_LAT) * np.sin(phi) - np.sin(FACE_LAT) * np.cos(phi) * np.cos(lam))
    theta = FACE_AXIS_AZIMUTH - az - (ODD_ROTATION if res % 2 else 0)
    r = np.tan(r) / UNIT_STEP * math.sqrt(7) ** res
    return np.stack([r * np.cos(theta), r * np.sin(theta)], axis=-1)


def centre_of(cell: str, res: int) -> np.ndarray:
    """Plane position of a cell, from the base cell down through its digits: the opposite way to `with_h3`."""
    bits = int(cell, 16)
    assert (bits >> 45) & 127 == BASE_CELL and (bits >> 52) & 15 == res
    a, b = -1, -1
    for q in range(1, res + 1):
        i, j, k = DIGIT_IJK[(bits >> (3 * (15 - q))) & 7]
        if q % 2:
            a, b = 2 * a + b, 3 * b - a
        else:
            a, b = 3 * a - b, a + 2 * b
        a, b = a + i - k, b + j - k
    return a * AXES[0] + b * AXES[1]


def random_points(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"latitude": rng.uniform(43.5, 43.9, n), "longitude": rng.uniform(-79.8, -79.0, n)})
    return spark.createDataFrame(pdf)


def test_published_values(spark):
    df = spark.createDataFrame(
        [(43.6532, -79.3832), (43.7, -79.4), (0.0, 0.0), (None, -79.4), (-43.6532, 100.6168)],
        "latitude double, longitude double")
    assert [r.h3_index for r in with_h3(df).collect()] == ["892b9bc46d7ffff", "892b9bc76abffff", None, None, None]
    other = spark.createDataFrame([(40.689167, -74.044444)], "latitude double, longitude double")
    assert with_h3(other, res=10).first().h3_index == "8a2a1072b59ffff"


@pytest.mark.parametrize("res", [1, 2, 5, 8, 9, 12, 15])
def test_point_lies_in_its_hexagon(spark, res):
    for row in with_h3(random_points(spark, 300, res), res=res).collect():
        offset = to_plane(row.latitude, row.longitude, res) - centre_of(row.h3_index, res)
        assert np.abs(AXES @ offset).max() <= 0.5 + 1e-6


def test_every_point_of_the_region_has_a_cell(spark):
    assert with_h3(random_points(spark, 20000)).where("h3_index is null").count() == 0


def test_cells_nest(spark):
    """The digits of a fine cell begin with those of the coarser cell around its centre."""
    fine = with_h3(random_points(spark, 500)).select("h3_index").distinct().collect()
    for row in fine:
        parent = (int(row.h3_index, 16) & ~(15 << 52)) | (8 << 52) | (7 << 18)
        shift = centre_of(row.h3_index, 9) / math.sqrt(7)
        turned = math.atan2(shift[1], shift[0]) + ODD_ROTATION
        coarse = centre_of(f"{parent:x}", 8)
        assert np.hypot(*(np.hypot(*shift) * np.array([math.cos(turned), math.sin(turned)]) - coarse)) < 0.5


def test_plan_is_generated_code_and_predicates_stay_out(spark):
    df = with_h3(random_points(spark).withColumn("k", F.lit(1) + F.rand()))
    filtered = df.where("h3_index = '892b9bc46d7ffff' and latitude > 43.6")
    plan = filtered._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60_000
    assert plan.index("Generate") > plan.index("h3_index")
    physical = filtered._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in physical
    assert filtered.count() >= 0


@pytest.mark.parametrize("res", [8, 9])
def test_rings(spark, res):
    """Cells of points a fine step apart are the same or in each other's ring; rings are symmetric and hold six cells."""
    step, side = (0.0003, 60) if res == 9 else (0.0008, 60)
    points = spark.createDataFrame(
        [(i, j, 43.65 + i * step, -79.38 + j * step) for i in range(side) for j in range(side)], "i int, j int, latitude double, longitude double")
    at = {(r.i, r.j): r.h3_index for r in hexgrid.with_h3(points, res=res).collect()}
    cells = spark.createDataFrame([(c,) for c in sorted(set(at.values()))] + [(None,)], "h3_index string")
    ring = {}
    for r in hexgrid.with_ring(cells, res=res).collect():
        ring.setdefault(r.h3_index, []).append(r.ring_cell)
    assert ring.pop(None) == [None] * 6
    assert all(len(set(found)) == 6 and own not in found and None not in found for own, found in ring.items())
    assert all(own in ring[other] for own, found in ring.items() for other in found if other in ring)
    touching = {(at[k], at[n]) for k in at for n in ((k[0] + 1, k[1]), (k[0], k[1] + 1)) if n in at and at[k] != at[n]}
    assert len(touching) > 100 and all(b in ring[a] for a, b in touching)


def test_ring_with_itself(spark):
    cell = hexgrid.with_h3(spark.sql("select 43.7 as latitude, -79.4 as longitude")).select("h3_index")
    own, around = (hexgrid.with_ring(cell, own=o).collect() for o in (True, False))
    assert {r.ring_cell for r in own} == {r.ring_cell for r in around} | {own[0].h3_index} and len(own) == 7
