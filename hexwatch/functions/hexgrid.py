"""Hexagon cell ids (H1) and point structs (H2).

The grid is the public icosahedral aperture-7 hexagon hierarchy. The accepted region lies on one icosahedron face
inside one base cell, so the id is a straight line of arithmetic:

1.  project the point onto the face plane. With unit vectors, both grid coordinates are a quotient of two dot
    products, so the only trigonometry per row is sin/cos of latitude and longitude;
2.  round to the nearest hexagon (cube rounding in axial coordinates);
3.  climb from the cell to the base cell. A parent is an exact division by a lattice element of norm 7, so the
    division's remainder (seven values) is the cell's digit under that parent.

Each step is one `select`: Catalyst keeps a projection separate when the next one uses its outputs more than once,
so nothing is computed twice and the whole chain stays in generated code. The finished id leaves through a one-row
`inline`. That is a fence for predicates on the id, and only for those: pushed down the chain, such a predicate would
be rewritten into the whole arithmetic, doubling in size at each level. Predicates on other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexwatch.settings import H3_RESOLUTION, SRID

# Fixed values of the grid: face 2 centre (radians), azimuth of its first axis, the odd-resolution rotation, the
# length of a resolution-0 step on the face plane, and the base cell with its axial position on that face.
FACE_LAT = 1.054751253523952054
FACE_LON = -1.347517358900396623
FACE_AXIS_AZIMUTH = 0.780213654393430055
ODD_ROTATION = 0.333473172251832115
UNIT_STEP = 0.38196601125010500003
BASE_CELL = 21
BASE_AXIAL = (-1, -1)

# Axial offset of the child that each digit names.
DIGIT_OFFSET = {0: (0, 0), 1: (-1, -1), 2: (0, 1), 3: (-1, 0), 4: (1, 0), 5: (0, -1), 6: (1, 1)}
# Names of the columns that carry the computation from step to step.
SCRATCH = {"_px", "_py", "_pz", "_a", "_b", "_c", "_ra", "_rb", "_rc", "_ea", "_eb", "_ec", "_id"}
# First row of the parent division (numerators over 7) at odd and at even resolutions.
PARENT_ROW = {1: (3, -1), 0: (2, 1)}


def _face_vectors(res: int) -> dict[str, tuple[float, float, float]]:
    """Vectors whose dot product with the point's unit vector gives face depth and scaled axial coordinates."""
    sin_lat, cos_lat = math.sin(FACE_LAT), math.cos(FACE_LAT)
    sin_lon, cos_lon = math.sin(FACE_LON), math.cos(FACE_LON)
    normal = (cos_lat * cos_lon, cos_lat * sin_lon, sin_lat)
    north = (-sin_lat * cos_lon, -sin_lat * sin_lon, cos_lat)
    east = (-sin_lon, cos_lon, 0.0)

    def plane_axes(azimuth: float, scale: float):
        c, s = math.cos(azimuth) * scale, math.sin(azimuth) * scale
        x_axis = tuple(c * n + s * e for n, e in zip(north, east))
        y_axis = tuple(s * n - c * e for n, e in zip(north, east))
        return x_axis, y_axis

    azimuth = FACE_AXIS_AZIMUTH - (ODD_ROTATION if res % 2 else 0.0)
    x_axis, y_axis = plane_axes(azimuth, math.sqrt(7.0) ** res / UNIT_STEP)
    root3 = math.sqrt(3.0)
    x0, y0 = plane_axes(FACE_AXIS_AZIMUTH, 1.0 / UNIT_STEP)
    return {
        "depth": normal,
        "a": tuple(x + y / root3 for x, y in zip(x_axis, y_axis)),
        "b": tuple(2.0 * y / root3 for y in y_axis),
        # The two face edges that touch the base cell: outward normals at 180 and 300 degrees, one step away.
        "edge1": tuple(-x for x in x0),
        "edge2": tuple(x * 0.5 - y * (root3 / 2.0) for x, y in zip(x0, y0)),
    }


def _dot(vector: tuple[float, float, float]) -> str:
    x, y, z = vector
    return f"(_px * {x!r}D + _py * {y!r}D + _pz * {z!r}D)"


def _climb(q: int) -> list[str]:
    """Parent of (_a, _b) at resolution q - 1, and the id with the cell's digit under that parent put in.

    The first numerator of the parent division has a different remainder for each of the seven digits; the digits,
    3 bits each, are looked up in one BIGINT by shifting.
    """
    row_a, row_b = PARENT_ROW[q % 2]
    first = f"({row_a}D * _a + {row_b}D * _b)"
    second = "(_a + 2D * _b)" if q % 2 else "(3D * _b - _a)"
    parent = f"cast(floor(({first} + 3D) / 7D) as double)"
    packed = sum(d << (3 * (row_a * da + row_b * db + 3)) for d, (da, db) in DIGIT_OFFSET.items())
    digit = f"(shiftright({packed}L, 3 * cast({first} - {parent} * 7D + 3D as int)) & 7L)"
    return [
        f"{parent} as _a",
        f"cast(floor(({second} + 3D) / 7D) as double) as _b",
        f"_id | shiftleft({digit}, {3 * (15 - q)}) as _id",
    ]


def with_h3(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    out: str = "h3_index",
    res: int = H3_RESOLUTION,
) -> DataFrame:
    """Add the cell id (15 hex digits) of each point; NULL for a missing point or one outside the base cell."""
    if not 1 <= res <= 15:
        raise ValueError(f"resolution must be 1..15, got {res}")
    taken = sorted(SCRATCH & {c.lower() for c in df.columns})
    if taken:
        raise ValueError(f"column names used inside the cell computation: {taken}")
    keep = [f"`{c}`" for c in df.columns if c != out]
    vec = _face_vectors(res)
    phi, lam = f"radians(cast(`{lat}` as double))", f"radians(cast(`{lon}` as double))"
    depth, a, b = _dot(vec["depth"]), _dot(vec["a"]), _dot(vec["b"])
    on_face = f"{depth} > 0D and {_dot(vec['edge1'])} <= {depth} and {_dot(vec['edge2'])} <= {depth}"
    worst_a = "_ea > _eb and _ea > _ec"
    steps = [
        # Unit vector of the point, then its axial coordinates on the face plane.
        [f"cos({phi}) * cos({lam}) as _px", f"cos({phi}) * sin({lam}) as _py", f"sin({phi}) as _pz"],
        [f"case when {on_face} then {a} / {depth} end as _a", f"case when {on_face} then {b} / {depth} end as _b"],
        # Nearest hexagon: round the three cube coordinates, then rebuild the worst one from the others.
        ["_a", "_b", "_b - _a as _c", "cast(floor(_a + 0.5D) as double) as _ra",
         "cast(floor(_b + 0.5D) as double) as _rb", "cast(floor(_b - _a + 0.5D) as double) as _rc"],
        ["_ra", "_rb", "_rc", "abs(_ra - _a) as _ea", "abs(_rb - _b) as _eb", "abs(_rc - _c) as _ec"],
        [f"case when {worst_a} then _rb - _rc else _ra end as _a",
         f"case when not ({worst_a}) and _eb > _ec then _ra + _rc else _rb end as _b", f"{_prefix(res)}L as _id"],
    ]
    return _with_id(df, keep, steps, out, res)


def _prefix(res: int) -> int:
    """An id of a resolution without its digits."""
    prefix = (1 << 59) | (res << 52) | (BASE_CELL << 45)
    for unused in range(res + 1, 16):
        prefix |= 7 << (3 * (15 - unused))
    return prefix


def _with_id(df: DataFrame, keep: list[str], steps: list[list[str]], out: str, res: int) -> DataFrame:
    """The steps that end with axial coordinates `_a`, `_b` and an id without digits, then the climb to the base cell."""
    step = df
    for columns in [*steps, *[_climb(q) for q in range(res, 0, -1)]]:
        step = step.selectExpr(*keep, *columns)
    inside = f"_a = {BASE_AXIAL[0]}D and _b = {BASE_AXIAL[1]}D"
    cell = f"inline(array(named_struct('{out}', case when {inside} then lower(hex(_id)) end)))"
    return step.selectExpr(*keep, cell)


def _descend(q: int) -> list[str]:
    """Axial coordinates at resolution q of the child that an id's digit names: the centre child's, by the inverse of the parent
    division, and the digit's offset, looked up by shifting."""
    digit = f"cast(shiftright(_id, {3 * (15 - q)}) & 7L as int)"
    offset = [sum((o[axis] + 1) << (2 * d) for d, o in DIGIT_OFFSET.items()) for axis in (0, 1)]
    a, b = ("2D * _a + _b", "3D * _b - _a") if q % 2 else ("3D * _a - _b", "_a + 2D * _b")
    return ["_id", *(f"{centre} + cast((shiftright({packed}, 2 * {digit}) & 3) - 1 as double) as {name}" for centre, packed, name in ((a, offset[0], "_a"), (b, offset[1], "_b")))]


def with_ring(df: DataFrame, cell: str = "h3_index", out: str = "ring_cell", res: int = H3_RESOLUTION, own: bool = False) -> DataFrame:
    """One row for each of the six cells around a cell, and with `own` one for itself: down the digits to the axial coordinates, one axial
    step, and up again, which is the carry from digit to digit. NULL for a NULL cell and beyond the base cell."""
    taken = sorted(SCRATCH & {c.lower() for c in df.columns})
    if taken:
        raise ValueError(f"column names used inside the cell computation: {taken}")
    keep = [f"`{c}`" for c in df.columns if c != out]
    moves = ", ".join(f"named_struct('_da', {a}D, '_db', {b}D)" for d, (a, b) in DIGIT_OFFSET.items() if d or own)
    steps = [
        [f"cast(conv(`{cell}`, 16, 10) as bigint) as _id", f"{BASE_AXIAL[0]}D as _a", f"{BASE_AXIAL[1]}D as _b"],
        *[_descend(q) for q in range(1, res + 1)],
        ["_id", "_a", "_b", f"inline(array({moves}))"],
        ["case when _id is not null then _a + _da end as _a", "_b + _db as _b", f"{_prefix(res)}L as _id"],
    ]
    return _with_id(df, keep, steps, out, res)


def make_point(lon: Column | str, lat: Column | str, srid: int = SRID) -> Column:
    """H2: the point as a plain struct, which every file format can store."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    point = F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y"), F.lit(srid).alias("srid"))
    return F.when(lon.isNotNull() & lat.isNotNull(), point)
