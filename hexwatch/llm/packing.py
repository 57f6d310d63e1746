"""Vector best-fit packing of token sequences (operator 8).

Every document is tokenised and closed with an end id; documents over the token capacity are cut so that only the first
piece is short. Pieces are packed by vector best fit: each bin has residual capacities of tokens, documents and attention
cost (the sum of squared piece lengths), and a piece goes to the open bin that holds it under every constraint and scores
best, by the weighted dot product of its demand with the residual, or by the weighted norm of what would be left.

At scale the pieces are dealt into blocks of a bounded number of pieces, each packed by one task; a block leaves at most
a few bins half full, so the loss is a small fraction of a percent. The tokens themselves are not shuffled.

Very long runs of white space are taken out of a text before the splitting pattern sees it, which recurses over them; they
are cut as the pattern would cut them, so the ids stay those of the whole text.

Defined results: null text counts as empty and yields one piece holding the end id; repeated rows are packed each for itself;
an empty table yields no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexwatch.llm.common import stored, text_array

CAPACITY = 1024
END_ID = 2
BLOCK_PIECES = 20_000
#: The splitting pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: What the pattern's white space is. Runs of this many are cut before the pattern is applied.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LONG_RUN = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: printable bytes are themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Ids of a byte-level vocabulary file, as its library gives them without special tokens added."""

    def __init__(self, path: str):
        import tiktoken

        spec = json.loads(open(path, encoding="utf-8").read())
        letters = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        ranks = {bytes(letters[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

        self.run = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")

    def encode(self, text: str) -> np.ndarray:
        if self.split is None or not any(s in text for s in self.special):
            return self.plain(text)
        parts, at = [], 0
        for m in self.split.finditer(text):
            parts += [self.plain(text[at : m.start()]), np.array([self.special[m[0]]], np.uint32)]
            at = m.end()
        return np.concatenate([*parts, self.plain(text[at:])])

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text without special tokens.

        The pattern makes one token stretch of a run of white space up to the text's end, and of all but the last of a run
        before another character; the last one begins the next stretch, or is one of its own.
        """
        parts, at = [], 0
        for m in self.run.finditer(text):
            end = m.end() - (m.end() < len(text))
            parts += [self.encoding.encode_to_numpy(text[at : m.start()], disallowed_special=()), self.stretch(text[m.start() : end])]
            at = end
        rest = self.encoding.encode_to_numpy(text[at:], disallowed_special=())
        return np.concatenate([*parts, rest]) if parts else rest

    def stretch(self, text: str) -> np.ndarray:
        """Ids of a text that the pattern does not cut."""
        return np.array(self.encoding._encode_single_piece(text), np.uint32)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than the capacity when there are several."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document: its place in the document's ids, its length, and a checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or ByteBpe(tokenizer)
            keys, out = batch.column(0).to_pylist(), ([], [], [], [], [])
            for key, text in zip(keys, text_array(batch.column(1))):
                ids = np.append(bpe.encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                raw = ids.tobytes()
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    for values, v in zip(out, (key, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]))):
                        values.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "dot") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; capacity: tokens, documents, attention cost of a bin; rule: `dot` or `norm`.

    Pieces are placed longest first. A piece beyond a capacity on its own is refused with ValueError.
    """
    demand = np.stack([lengths, np.ones_like(lengths), lengths * lengths], 1).astype(np.float64)
    if len(lengths) and (demand > capacity).any():
        raise ValueError("a piece is larger than a bin")
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.zeros((1024, 3))
    ids = np.zeros(1024, np.int64)
    live = made = 0
    smallest = demand.min(axis=0) if len(lengths) else capacity
    for i in order:
        need = demand[i]
        room = left[:live]
        fits = np.flatnonzero((room[:, 0] >= need[0]) & (room[:, 1] >= need[1]) & (room[:, 2] >= need[2]))
        if len(fits):
            rest = (room[fits] - need) / capacity
            if rule == "norm":
                worth = (weights * rest * rest).sum(1)
            else:  # tightest alignment: the least weighted product of demand and residual
                worth = (room[fits] / capacity) @ (weights * need / capacity)
            k = int(fits[np.argmin(worth)])
        else:
            if live == len(left):
                left, ids = np.concatenate((left, np.zeros_like(left))), np.concatenate((ids, np.zeros_like(ids)))
            k, live = live, live + 1
            left[k], ids[k], made = capacity, made, made + 1
        bins[i], offsets[i] = ids[k], capacity[0] - left[k, 0]
        left[k] -= need
        if (left[k] < smallest).any():  # nothing fits any more: the last open bin takes its place
            live -= 1
            left[k], ids[k] = left[live], ids[live]
    return bins, offsets


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, max_documents: int | None = None, max_attention: int | None = None,
         weights: tuple[float, float, float] = (1.0, 0.05, 0.25), rule: str = "dot", block: int = BLOCK_PIECES) -> DataFrame:
    """Place stored pieces in sequences. The default document and attention capacities bind nothing beyond the tokens.

    Sequence numbers are unique over all blocks, not dense.
    """
    limits = np.array([capacity, max_documents or capacity, max_attention or capacity * capacity], np.float64)
    factors = np.array(weights)
    n_blocks = max(1, math.ceil(cut_pieces.count() / block))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = group.column("length").to_numpy()
        bins, offsets = best_fit(lengths, limits, factors, rule)
        base = group.column("block")[0].as_py() << 32
        return group.select(names).append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(offsets))

    # Dealt by all of a piece's columns, so that neither one long document nor repeated rows gather in a block.
    dealt = cut_pieces.withColumn("block", F.pmod(F.xxhash64(*names), F.lit(n_blocks)).cast("long"))
    return dealt.groupBy("block").applyInArrow(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    capacity = options.get("capacity", CAPACITY)
    return pack(stored(pieces(docs, tokenizer, capacity), "pieces"), **options)
