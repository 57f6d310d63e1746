"""Vector code compression by dual-tree Lloyd rounds (operator 12).

Vectors of integers are cut into parts, every part position has a codebook, and a few rounds move its entries to the means of
the parts nearest to them. Rows are stored once as blocks; a block has, for every part position, a tree over its parts in
which each node knows its bounding box and the sum of its parts. Every round broadcasts the codebooks (a fixed number of
entries), and each task walks the trees of its blocks against trees over the entries: a pair of nodes is dropped if their boxes
are farther apart than the nearest entry can be from any part of the node. Where single entries are left, an entry is dropped
if another one is nearer to the whole box; a node with one entry left is assigned whole, by its cached sum. Leaves with
several entries left compare integers. Sums and counts of entries are added up by an aggregation with a row per task and
entry. All arithmetic is exact in 64-bit integers, so the result depends neither on the trees nor on how rows are dealt.

Defined results: rows with a null vector, or with null or non-finite components, are dropped, as are components of 2^18 and
more in size, whose squared distances might not fit 64 bits; vectors of another length than that of the least vec_id, or of a
length that the parts do not divide, have null code and errors; null vec_ids sort last and so start a codebook only where
there are too few others; repeated rows count each, ties of one vec_id are broken by the vector; with fewer rows than entries the
codebooks are shorter; null labels are summed together; an empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexwatch.llm.common import column, small, stored

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Components must be smaller than this, so that integers stay under 2^28 and sums of squares under 2^63.
LARGEST = float(1 << 18)
BLOCK_ROWS, LEAF_ROWS = 8192, 128
RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


@dataclass
class Tree:
    """A balanced tree over points: children of node i are 2i+1 and 2i+2; `points` are in the order of the leaves.

    `starts` has the first point of every node, `ends` the one after its last.
    """

    points: np.ndarray
    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def first_leaf(self) -> int:
        return len(self.starts) // 2


def ranges(n: int, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the nodes of a tree over n points, halved until a node has at most `leaf`, but at least one."""
    edges = [np.array([0, n])]
    while (most := -(-n // (len(edges[-1]) - 1))) > leaf and most > 1 and n >= 2 * (len(edges[-1]) - 1):
        e = edges[-1]
        mid = (e[:-1] + e[1:]) // 2
        edges.append(np.insert(e, np.arange(1, len(e)), mid))
    return np.concatenate([e[:-1] for e in edges]), np.concatenate([e[1:] for e in edges])


def tree_over(points: np.ndarray, leaf: int) -> Tree:
    """Every level sorts each node's points along its widest side and halves them."""
    n = len(points)
    starts, ends = ranges(n, leaf)
    order = np.arange(n)
    at, width = 0, 1
    low, high, sums = (np.zeros((len(starts), points.shape[1]), np.int64) for _ in range(3))
    while at < len(starts):
        own = slice(at, at + width)
        x = points[order]
        low[own], high[own] = np.minimum.reduceat(x, starts[own]), np.maximum.reduceat(x, starts[own])
        sums[own] = np.add.reduceat(x, starts[own])
        at += width
        if at < len(starts):
            node = np.repeat(np.arange(width), ends[own] - starts[own])
            side = (high[own] - low[own]).argmax(1)
            order = order[np.lexsort((x[np.arange(n), side[node]], node))]
            width *= 2
    return Tree(points[order], order, low, high, sums, starts, ends)


@dataclass
class EntryTree(Tree):
    """A tree over a codebook, with the entries by index and the leaf of every point."""

    by_index: np.ndarray
    leaf_of: np.ndarray

    @classmethod
    def of(cls, codebook: np.ndarray) -> EntryTree:
        t = tree_over(codebook, 1)
        leaves = np.arange(t.first_leaf, len(t.starts))
        return cls(**vars(t), by_index=codebook, leaf_of=np.repeat(leaves, t.ends[leaves] - t.starts[leaves]))


def square(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def single_entries(tree: Tree, entries: EntryTree, node: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Which (node, single entry) pairs stay, if for each node another entry that is nearer to all of its box rules them out.

    Pairs are sorted by node. The difference of two squared distances is linear in the point, so its least value over a box is
    at a corner. An entry also goes where it can only be as near and has the higher index.
    """
    low, high, e, index = tree.low[node], tree.high[node], entries.points[entry], entries.order[entry]
    from_centre = square(2 * e - low - high)
    best = np.lexsort((index, from_centre, node))
    first = np.flatnonzero(np.diff(node[best], prepend=-1))
    rival = np.repeat(best[first], np.diff(np.append(first, len(node))))  # per sorted pair: the node's nearest entry
    gap = e - e[rival]
    least = square(e) - square(e[rival]) - 2 * np.maximum(low * gap, high * gap).sum(1)
    return (np.arange(len(node)) == rival) | (least < 0) | (least == 0) & (index < index[rival])


def compared(x: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared distances of points and entries, less the point's own square. Products of integers are whole numbers in doubles as
    well, which have the faster product, as long as no sum passes 2^53."""
    most = max(int(np.abs(x).max()), int(np.abs(e).max()))
    product = (x.astype(np.float64) @ e.T.astype(np.float64)).astype(np.int64) if most * most * x.shape[1] < 1 << 53 else x @ e.T
    return square(e) - 2 * product


def assign(tree: Tree, entries: EntryTree) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """The nearest entry of every point in tree order, sums and counts of the entries, and how much was done which way."""
    k, d = entries.points.shape
    codes = np.zeros(len(tree.points), np.int64)
    sums, counts = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
    done = {"pairs": 0, "whole": 0, "compared": 0}
    bound = np.full(len(tree.starts), np.iinfo(np.int64).max)
    node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
    spread, entry_spread = (square(t.high - t.low) for t in (tree, entries))
    entry_leaf = np.arange(len(entries.starts)) >= entries.first_leaf
    while len(node):
        done["pairs"] += len(node)
        apart = np.maximum(np.maximum(tree.low[node] - entries.high[other], entries.low[other] - tree.high[node]), 0)
        across = np.maximum(tree.high[node] - entries.low[other], entries.high[other] - tree.low[node])
        np.minimum.at(bound, node, square(across))
        keep = square(apart) <= bound[node]
        node, other = node[keep], other[keep]
        group = np.flatnonzero(np.diff(node, prepend=-1))
        size = np.diff(np.append(group, len(node)))
        ready = np.minimum.reduceat(entry_leaf[other], group)  # only leaves of the entry tree are left
        widest = np.maximum.reduceat(np.where(entry_leaf[other], -1, entry_spread[other]), group)
        own = node[group]
        is_leaf = own >= tree.first_leaf
        open_ = np.repeat(ready, size)
        waiting_node, waiting_other = node[~open_], other[~open_]

        # Nodes with nothing but leaves of the entry tree: look at the single entries.
        n1, o1 = node[open_], other[open_]
        reach = entries.ends[o1] - entries.starts[o1]
        n1 = np.repeat(n1, reach)
        e1 = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(entries.starts[o1], reach)
        if len(n1):
            keep = single_entries(tree, entries, n1, e1)
            n1, e1 = n1[keep], e1[keep]
        first = np.flatnonzero(np.diff(n1, prepend=-1))
        many = np.diff(np.append(first, len(n1)))
        for at, m in zip(first.tolist(), many.tolist()):
            i = int(n1[at])
            a, b = int(tree.starts[i]), int(tree.ends[i])
            if m == 1:  # one entry left: the whole node, by its cached sum
                entry = entries.order[e1[at]]
                codes[a:b] = entry
                sums[entry] += tree.sums[i]
                counts[entry] += b - a
                done["whole"] += b - a
            elif i >= tree.first_leaf:
                index = np.sort(entries.order[e1[at : at + m]])
                x, e = tree.points[a:b], entries.by_index[index]
                found = index[compared(x, e).argmin(1)]  # the first of equals has the lower index
                codes[a:b] = found
                np.add.at(sums, found, x)
                counts += np.bincount(found, minlength=k)
                done["compared"] += (b - a) * m
        split = np.repeat((many > 1) & (n1[first] < tree.first_leaf), many)
        n1, e1 = n1[split], entries.leaf_of[e1[split]]
        if len(n1):  # entries of one leaf go on as one pair
            n1, e1 = np.unique(np.stack((n1, e1)), axis=1)

        # Of the others, the wider one of the two is split.
        halve = np.repeat((spread[own] > widest) & ~is_leaf, size)[~open_]
        n2, o2 = waiting_node[halve], waiting_other[halve]
        n3, o3 = waiting_node[~halve], waiting_other[~halve]
        leaf3 = entry_leaf[o3]
        down_node = np.concatenate((n1, n2))
        for child in (1, 2):
            bound[2 * down_node + child] = bound[down_node]
        node = np.concatenate((2 * down_node + 1, 2 * down_node + 2, n3[leaf3], n3[~leaf3], n3[~leaf3]))
        other = np.concatenate((e1, o2, e1, o2, o3[leaf3], 2 * o3[~leaf3] + 1, 2 * o3[~leaf3] + 2))
        sort = np.lexsort((other, node))
        node, other = node[sort], other[sort]
    return codes, sums, counts, done


def kept(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector of integers) of the rows that count."""
    vector = column(rows, "embedding")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    whole = F.transform(vector, lambda x: F.floor(x * SCALE).cast("int"))
    # The filter asks for a vector that is there; a null one makes the condition null.
    return rows.where(sound).select(column(rows, "vec_id").cast("long").alias("vec_id"), column(rows, "label").alias("label"), whole.alias("vector"))


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Parts of the vectors with the least ids as (part, entry, component); empty without any."""
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    least = vectors.select("vec_id", "vector").orderBy(*order).limit(1).collect()  # its length is everyone's
    d = len(least[0]["vector"]) if least else 0
    if not d or d % parts:
        return np.zeros((parts, 0, 0), np.int64)
    rows = vectors.where(F.size("vector") == d).select("vec_id", "vector").orderBy(*order).limit(entries).collect()
    return np.array([r["vector"] for r in rows], np.int64).reshape(len(rows), parts, d // parts).transpose(1, 0, 2)


def blocks(vectors: DataFrame, parts: int, width: int, block_rows: int, leaf_rows: int) -> DataFrame:
    """Rows in blocks with a tree per part position: ids, labels, and the trees' arrays as bytes, which only `restored` reads."""
    label = vectors.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: pa.Table) -> pa.RecordBatch:  # one row
            n = len(held)
            x = held.column("vector").combine_chunks().flatten().to_numpy().astype(np.int64).reshape(n, parts, width)
            trees = [packed_tree(tree_over(np.ascontiguousarray(x[:, p]), leaf_rows)) for p in range(parts)]
            ids, labels = (pa.array([held.column(c).to_pylist()], pa.list_(held.schema.field(c).type)) for c in ("vec_id", "label"))
            return pa.RecordBatch.from_arrays([ids, labels, pa.array([trees], pa.list_(pa.binary()))], names=["vec_ids", "labels", "trees"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, len(batch), block_rows):
                piece = batch.slice(at, block_rows)
                if held and sum(map(len, held)) + len(piece) > block_rows:
                    yield packed(pa.Table.from_batches(held))
                    held = []
                held.append(piece)
        if sum(map(len, held)):
            yield packed(pa.Table.from_batches(held))

    return vectors.mapInArrow(run, f"vec_ids array<bigint>, labels array<{label}>, trees array<binary>")


STORED = (("points", np.int32), ("order", np.int32), ("low", np.int32), ("high", np.int32), ("sums", np.int64))


def padded(size: int) -> int:
    return -(-size // 8) * 8


def packed_tree(t: Tree) -> bytes:
    arrays = [getattr(t, name).astype(kind).tobytes() for name, kind in STORED]
    return b"".join(a.ljust(padded(len(a)), b"\0") for a in arrays)


def restored(data: bytes, n: int, width: int, leaf_rows: int) -> Tree:
    starts, ends = ranges(n, leaf_rows)
    at, out = 0, []
    for (_, kind), count in zip(STORED, (n * width, n, *[len(starts) * width] * 3)):
        out.append(np.frombuffer(data, kind, count, at).astype(np.int64))
        at += padded(count * np.dtype(kind).itemsize)
    points, order, low, high, sums = out
    return Tree(points.reshape(n, width), order, *(x.reshape(-1, width) for x in (low, high, sums)), starts, ends)


def moved(stored_blocks: DataFrame, codebooks: np.ndarray, leaf_rows: int) -> np.ndarray:
    """The codebooks after a round: means of the parts nearest to each entry, floored; entries without parts stay."""
    parts, k, width = codebooks.shape
    shared = stored_blocks.sparkSession.sparkContext.broadcast(codebooks)  # parts x entries x width integers
    names = [f"s{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree.of(c) for c in shared.value]
        sums, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for ids, data in zip(batch.column("vec_ids"), batch.column("trees")):
                for p in range(parts):
                    _, s, c, _ = assign(restored(data[p].as_py(), len(ids), width, leaf_rows), trees[p])
                    sums[p] += s
                    counts[p] += c
        p, e = np.nonzero(counts)
        columns = [p, e, counts[p, e], *sums[p, e].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names=["part", "entry", "n", *names])

    found = stored_blocks.select("vec_ids", "trees").mapInArrow(run, ", ".join(f"{c} long" for c in ("part", "entry", "n", *names)))
    total = found.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ("n", *names)))
    out = codebooks.copy()
    for r in total.collect():  # at most parts x entries rows
        out[r["part"], r["entry"]] = [r[c] // r["n"] for c in names]
    shared.unpersist()
    return out


def assigned(stored_blocks: DataFrame, codebooks: np.ndarray, leaf_rows: int) -> DataFrame:
    """(vec_id, label, code, error) of every row of the blocks."""
    parts, _, width = codebooks.shape
    shared = stored_blocks.sparkSession.sparkContext.broadcast(codebooks)
    label = stored_blocks.schema["labels"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree.of(c) for c in shared.value]
        for batch in batches:
            for ids, labels, data in zip(batch.column("vec_ids"), batch.column("labels"), batch.column("trees")):
                n = len(ids)
                codes, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
                for p in range(parts):
                    tree = restored(data[p].as_py(), n, width, leaf_rows)
                    own = assign(tree, trees[p])[0]
                    codes[tree.order, p] = own
                    error[tree.order] += square(tree.points - trees[p].by_index[own])
                digits, step = codes.astype(np.uint8).tobytes().hex(), 2 * parts
                text = pa.array([digits[i : i + step] for i in range(0, len(digits), step)])
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, text, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return stored_blocks.mapInArrow(run, f"vec_id long, label {label.simpleString()}, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compressed(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS,
               leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Per kept row of (vec_id, embedding, label): its code, error, its label's total error, and the hash of all codebooks.

    A code has two hex digits a part; entries must therefore be 256 at most.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has between 1 and 256 entries")
    vectors = kept(rows)
    codebooks = first_codebooks(vectors, parts, entries)
    width = codebooks.shape[2]
    fitting = F.size("vector") == parts * width if width else F.lit(False)
    others = vectors.where(~fitting).select("vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"),
                                            F.lit(None).cast("long").alias("label_error"))
    if not width:
        return others.withColumn("codebooks_sha256", F.lit(digest(codebooks)))
    held = stored(blocks(vectors.where(fitting), parts, width, block_rows, leaf_rows), "vector-blocks")
    for _ in range(rounds):
        codebooks = moved(held, codebooks, leaf_rows)
    found = stored(assigned(held, codebooks, leaf_rows), "vector-codes")
    totals = small(stored(found.groupBy(F.col("label").alias("own_label")).agg(F.sum("error").alias("label_error")), "label-errors"))
    joined = found.join(totals, F.col("label").eqNullSafe(F.col("own_label")), "left")
    return joined.select("vec_id", "code", "error", "label_error").unionByName(others).withColumn("codebooks_sha256", F.lit(digest(codebooks)))
