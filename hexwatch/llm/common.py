"""Helpers of the operators: tables, shared intermediate tables, and vectorised views of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexwatch.session import shared_dir

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write under the shared folder and read again: later jobs neither repeat the work nor depend on its executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A stored table with short rows, marked for broadcast if it has at most `most` of them; else it is joined by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or it with underscores before it until no column of `df` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, dots and back ticks included."""
    return df["`" + name.replace("`", "``") + "`"]


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model may learn from; a null id is in no held-out fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_columns(df: DataFrame, text: str, fields: dict[str, T.DataType], make) -> DataFrame:
    """Every row of `df` with columns that `make(texts)` derives from the Arrow array of its texts (nulls as empty).

    `make` returns one array for each of `fields`. Columns with a new name, in any case, are replaced.
    """
    new = {f.lower() for f in fields}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in new]
    names = [df.schema.fields[i].name for i in kept]
    schema = T.StructType([*(df.schema.fields[i] for i in kept), *(T.StructField(k, v) for k, v in fields.items())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(text_array(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*(batch.columns[i] for i in kept), *(as_array(x) for x in made)], names=[*names, *fields])

    # Plain names on the way in: a function over Arrow batches looks columns up by name, and dots would be taken apart.
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(run, schema)


def as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def text_array(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return pc.fill_null(array, "") if array.null_count else array


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each text begins; the last bound is the end."""
    if pa.types.is_null(array.type):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if len(array) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(bounds: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together; a longer text is a range of its own, whole."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Polynomial hashes modulo 2^64 of any spans of one byte array, from running sums."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    @classmethod
    def _powers(cls, n: int) -> None:
        if len(cls._up) <= n:
            size = max(n + 1, BLOCK_BYTES + 1)
            up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
            up[0] = down[0] = 1
            cls._up, cls._down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        self._powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self._down[start]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))  # a byte a position
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def breaks_at(inside: np.ndarray, bounds: Iterable[int]) -> np.ndarray:
    """Positions of `bounds` that lie inside a run; such a run must be cut there."""
    b = np.asarray(bounds)
    b = b[(b > 0) & (b < len(inside))]
    return b[inside[b] & inside[b - 1]]


def spans_in(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of true values, cut where a text ends."""
    start, end = runs(inside)
    cut = breaks_at(inside, np.unique(bounds))
    if len(cut):
        start, end = np.sort(np.concatenate((start, cut))), np.sort(np.concatenate((end, cut)))
    return start, end
