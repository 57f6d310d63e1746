"""Covers of coordinate boxes by hexagon cells (P16, M7), and coarser cells of a cell (H1).

Ids of one resolution sort so that the descendants of a coarser cell stand together. A box is therefore a short list of id ranges:
cells that may hold descendants in the box are refined as long as they are at its rim, cells inside stay coarse.
Comparisons of ids with the ends of the ranges reach the file scan, and a table that is sorted by cell skips the row groups
between them. Rows of the ranges are then tested by their coordinates, so the result is exact.

A cell's descendants are not inside its outline. Each lies at most a step of its own resolution from its parent's centre, so
all of them lie within a distance of the cell's centre that the steps of all finer resolutions add up to.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexwatch.functions.hexgrid import BASE_AXIAL, BASE_CELL, DIGIT_OFFSET, UNIT_STEP, _face_vectors
from hexwatch.operators.clean import in_box
from hexwatch.settings import H3_RESOLUTION, Box

ROOT7 = math.sqrt(7.0)
#: Steps per side of a box at which its outline is followed; between two of them a parallel is as good as straight.
OUTLINE_STEPS = 64
MAX_CELLS, MAX_RANGES = 512, 32
Point = tuple[float, float]


def _axes(res: int) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Unit vectors of the plane's axes at a resolution, from the vectors of its axial coordinates."""
    vec, scale = _face_vectors(res), UNIT_STEP / ROOT7**res
    y = tuple(v * math.sqrt(3.0) / 2.0 * scale for v in vec["b"])
    return tuple(a * scale - v / math.sqrt(3.0) for a, v in zip(vec["a"], y)), y


def _dot(a, b) -> float:
    return sum(x * y for x, y in zip(a, b))


def on_plane(lat: float, lon: float) -> Point:
    """Where a point lies on the face plane, in the axes of even resolutions."""
    phi, lam = math.radians(lat), math.radians(lon)
    p = math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)
    depth = _dot(p, _face_vectors(0)["depth"])
    x, y = _axes(0)
    return _dot(p, x) / depth, _dot(p, y) / depth


def centre(a: int, b: int, res: int) -> Point:
    """The centre of a cell on the plane, in the axes of even resolutions."""
    step = UNIT_STEP / ROOT7**res
    y = b * math.sqrt(3.0) / 2.0 * step
    x = a * step - y / math.sqrt(3.0)
    ex, ey = _axes(res)
    x0, y0 = _axes(0)
    p = tuple(x * u + y * v for u, v in zip(ex, ey))
    return _dot(p, x0), _dot(p, y0)


def children(a: int, b: int, res: int) -> list[tuple[int, int, int]]:
    """(digit, axial coordinates) of the seven cells of resolution `res` under a cell of the one before."""
    ca, cb = (2 * a + b, 3 * b - a) if res % 2 else (3 * a - b, a + 2 * b)
    return [(d, ca + da, cb + db) for d, (da, db) in DIGIT_OFFSET.items()]


def outline(box: Box) -> list[Point]:
    corners = [(box.lat_min, box.lon_min), (box.lat_min, box.lon_max), (box.lat_max, box.lon_max), (box.lat_max, box.lon_min)]
    points = []
    for (la, lo), (lb, lp) in zip(corners, [*corners[1:], corners[0]]):
        points += [on_plane(la + (lb - la) * k / OUTLINE_STEPS, lo + (lp - lo) * k / OUTLINE_STEPS) for k in range(OUTLINE_STEPS)]
    return points


def distance(p: Point, ring: list[Point]) -> float:
    """How far a point is from a closed line; negative inside."""
    best, inside = math.inf, False
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
        dx, dy = bx - ax, by - ay
        t = min(1.0, max(0.0, ((p[0] - ax) * dx + (p[1] - ay) * dy) / ((dx * dx + dy * dy) or 1.0)))
        best = min(best, math.hypot(p[0] - ax - t * dx, p[1] - ay - t * dy))
        if (ay > p[1]) != (by > p[1]) and p[0] < ax + (p[1] - ay) / (by - ay) * dx:
            inside = not inside
    return -best if inside else best


def reach(res: int, finest: int) -> float:
    """Greatest distance from a cell's centre to a point of one of its descendants at `finest`, with a hundredth to spare."""
    steps = sum(UNIT_STEP / ROOT7**k for k in range(res + 1, finest + 1))
    return 1.01 * (steps + UNIT_STEP / ROOT7**finest / math.sqrt(3.0))


def cover(box: Box, res: int = H3_RESOLUTION, max_cells: int = MAX_CELLS) -> list[tuple[tuple[int, ...], bool]]:
    """(digits of a cell, whether all its descendants lie in the box): cells of several resolutions that hold every cell with a
    point of the box, as far as it lies in the grid's base cell. Rim cells are refined until there are `max_cells`."""
    ring = outline(box)
    done: list[tuple[tuple[int, ...], bool]] = []
    rim = [((), *BASE_AXIAL)]
    for level in range(1, res + 1):
        following = []
        for digits, a, b in rim:
            for d, ca, cb in children(a, b, level):
                far, most = distance(centre(ca, cb, level), ring), reach(level, res)
                if far < -most:
                    done.append(((*digits, d), True))
                elif far <= most:
                    following.append(((*digits, d), ca, cb))
        rim = following
        if len(done) + len(rim) > max_cells:
            break
    return done + [(digits, False) for digits, _, _ in rim]


def id_of(number: int, res: int) -> str:
    """The id of the cell whose digits, read in base 7, are `number`."""
    out = (1 << 59) | (res << 52) | (BASE_CELL << 45)
    for k in range(res + 1, 16):
        out |= 7 << (3 * (15 - k))
    for k in range(res, 0, -1):
        number, digit = divmod(number, 7)
        out |= digit << (3 * (15 - k))
    return f"{out:x}"


def id_ranges(box: Box, res: int = H3_RESOLUTION, max_cells: int = MAX_CELLS, max_ranges: int = MAX_RANGES) -> list[tuple[str, str]]:
    """First and last id of at most `max_ranges` ranges that hold every cell with a point of the box; the smallest gaps are closed."""
    spans = []
    for digits, _ in cover(box, res, max_cells):
        number = 0
        for d in digits:
            number = number * 7 + d
        size = 7 ** (res - len(digits))
        spans.append((number * size, (number + 1) * size - 1))
    spans.sort()
    gaps = sorted((b[0] - a[1] for a, b in zip(spans, spans[1:]) if b[0] > a[1] + 1), reverse=True)
    widest = set(gaps[: max_ranges - 1])
    least = min(widest) if widest else math.inf
    out: list[list[int]] = []
    for low, high in spans:
        if out and (low - out[-1][1] < least or low == out[-1][1] + 1):
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    while len(out) > max_ranges:  # equal gaps
        k = min(range(len(out) - 1), key=lambda i: out[i + 1][0] - out[i][1])
        out[k : k + 2] = [[out[k][0], out[k + 1][1]]]
    return [(id_of(low, res), id_of(high, res)) for low, high in out]


def in_cells(box: Box, cell: str = "h3_index", **options) -> Column:
    """Whether an id lies in the box's ranges; false for all if the box touches no cell."""
    test = F.lit(False)
    for low, high in id_ranges(box, **options):
        test = test | F.col(cell).between(low, high)
    return test


def in_box_by_cell(box: Box, lat: str = "latitude", lon: str = "longitude", cell: str = "h3_index", **options) -> Column:
    """P16 over a table with cells: the ranges of ids, which the scan can use, and the exact test of the coordinates."""
    return in_cells(box, cell, **options) & in_box(F.col(lat), F.col(lon), box)


def parent_cell(cell: Column, res: int, finest: int = H3_RESOLUTION) -> Column:
    """H1: the coarser cell that a cell belongs to, by the bits of its id; NULL for NULL."""
    if not 0 <= res <= finest:
        raise ValueError(f"a cell of resolution {finest} has no parent at {res}")
    mask = 0
    for k in range(res + 1, 16):
        mask |= 7 << (3 * (15 - k))
    number = F.conv(cell, 16, 10).cast("bigint")
    cleared = number.bitwiseAND(F.lit(~(15 << 52)).cast("bigint"))
    return F.lower(F.hex(cleared.bitwiseOR(F.lit(mask | (res << 52)).cast("bigint"))))
