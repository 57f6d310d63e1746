"""Token counts of whole texts (operator 11).

Arrow functions hand texts to the library of a vocabulary file and return lengths only: `sentencepiece` for `.model` files,
`tokenizers` for `.json` files, as they count by default but without begin, end or other added tokens, truncation or padding.
The calls are balanced by bytes: texts are taken together up to a number of bytes, and a long text is cut into parts at
boundaries that no token can cross, so that a call's memory and time are bounded by its bytes, not by a batch's longest text.
Equal texts of a batch are counted once. There is no shuffle.

Where a text may be cut:

- `.model`: the text is normalised whole, then cut between two characters that no piece of the vocabulary holds side by side.
  Merging joins neighbours into pieces only, so nothing is ever merged across such a place. This holds for merge (BPE) models
  with byte fallback and without user-defined pieces; texts of other models are not cut.
- `.json`: before white space that follows another character, where the byte-level splitting pattern always ends a match; only
  for byte-level models without normaliser and prefix space whose special tokens hold no white space. Others are not cut.

Defined results: null counts as the empty text, which has 0 bytes and 0 tokens; very long texts are counted whole, and one
without any boundary goes to the library in one piece; repeated rows are counted each; ties do not arise; an empty table
yields no rows; all other columns pass through, and a column with the name of a result, in any case, is replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexwatch.llm.common import column, with_columns
from hexwatch.llm.packing import WHITE
from hexwatch.llm.sentencepiece import BYTE, CONTROL, NORMAL, UNKNOWN, proto_fields

#: Characters of a part of a long text, and bytes of the texts of one call.
PART_CHARS = 1 << 16
CALL_BYTES = 1 << 20
TOKEN_LIMIT = 4096
#: Fixed value: the trainer's number of merge models.
MERGE_MODEL = 2


class PieceCounter:
    """Counts of a `.model` file."""

    def __init__(self, path: str):
        import sentencepiece

        data = open(path, "rb").read()
        pieces, trainer = [], {}
        for field, value in proto_fields(data):
            if field == 1:
                pieces.append(dict(proto_fields(value)))
            elif field == 2:
                trainer |= dict(proto_fields(value))
        kinds = {p.get(3, NORMAL) for p in pieces}
        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        # The same model without normalisation, for parts of a normalised text.
        plain = b"\x12\x00\x18\x00\x20\x00\x28\x00"
        self.part = sentencepiece.SentencePieceProcessor(model_proto=data + b"\x1a" + bytes([len(plain)]) + plain)
        self.cuts = trainer.get(3) == MERGE_MODEL and bool(trainer.get(35)) and kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        texts = [p.get(1, b"").decode() for p in pieces if p.get(3, NORMAL) == NORMAL]
        self.joined = frozenset(t[i : i + 2] for t in texts for i in range(len(t) - 1))

    def parts(self, text: str, size: int) -> Iterator[str]:
        """A normalised text in parts of `size` characters, each up to the next place that no piece spans."""
        start = 0
        while len(text) - start > size:
            end = start + size
            while end < len(text) and text[end - 1 : end + 1] in self.joined:
                end += 1
            yield text[start:end]
            start = end
        if start < len(text):
            yield text[start:]

    def split(self, text: str, size: int) -> list[str] | None:
        return list(self.parts(self.whole.normalize(text), size)) if self.cuts and len(text) > size else None

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.whole.encode(texts, num_threads=1)]

    def part_lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.part.encode(texts, num_threads=1)]


class ByteLevelCounter:
    """Counts of a `.json` file."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(open(path, encoding="utf-8").read())
        before = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        self.cuts = (
            spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(f"[{WHITE}]", t["content"]) for t in added)
        )
        self.edge = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")

    def split(self, text: str, size: int) -> list[str] | None:
        if not self.cuts or len(text) <= size:
            return None
        out, start = [], 0
        while len(text) - start > size and (m := self.edge.search(text, start + size)):
            out.append(text[start : m.start()])
            start = m.start()
        return [*out, text[start:]]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    part_lengths = lengths


Counter = PieceCounter | ByteLevelCounter
_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per file and Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = ByteLevelCounter(path) if path.endswith(".json") else PieceCounter(path)
    return _COUNTERS[path]


def in_calls(texts: Iterable[tuple[int, str]], measure: Callable[[list[str]], list[int]], totals: np.ndarray, most: int) -> None:
    """Add the lengths of (row, text) pairs to the rows' totals, taking texts together up to `most` bytes a call."""
    rows: list[int] = []
    held: list[str] = []
    size = 0
    for row, text in texts:
        n = len(text) if text.isascii() else len(text.encode())
        if held and size + n > most:
            np.add.at(totals, rows, measure(held))
            rows, held, size = [], [], 0
        rows.append(row)
        held.append(text)
        size += n
    if held:
        np.add.at(totals, rows, measure(held))


def lengths_of(texts: pa.Array, counts: Counter, part_chars: int = PART_CHARS, call_bytes: int = CALL_BYTES) -> np.ndarray:
    """Numbers of tokens of the texts of an Arrow array without nulls."""
    distinct = texts.dictionary_encode()
    totals = np.zeros(len(distinct.dictionary), np.int64)
    cut: list[int] = []

    def short() -> Iterator[tuple[int, str]]:
        for row, text in enumerate(distinct.dictionary):
            text = text.as_py()
            if counts.cuts and len(text) > part_chars:
                cut.append(row)
            else:
                yield row, text

    def parts() -> Iterator[tuple[int, str]]:
        for row in cut:
            yield from ((row, p) for p in counts.split(distinct.dictionary[row].as_py(), part_chars))

    in_calls(short(), counts.lengths, totals, call_bytes)
    in_calls(parts(), counts.part_lengths, totals, call_bytes)
    return totals[distinct.indices.to_numpy()]


def counted(docs: DataFrame, path: str, text: str = "text", limit: int = TOKEN_LIMIT, part_chars: int = PART_CHARS,
            call_bytes: int = CALL_BYTES) -> DataFrame:
    """All rows with n_bytes, n_tokens, and over_limit: more tokens than `limit`."""
    found = with_columns(docs, text, {"n_tokens": T.LongType()}, lambda texts: [lengths_of(texts, counter(path), part_chars, call_bytes)])
    kept = [column(found, c) for c in found.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    n_bytes = F.coalesce(F.octet_length(column(found, text)), F.lit(0)).cast("long")
    return found.select(*kept, n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
