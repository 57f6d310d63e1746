"""SentencePiece encoding with byte offsets, and decoding (operator 5).

Texts are normalised by longest prefixes found in the model's compiled character map, a double-array trie over UTF-8 bytes;
every byte of the normalised text keeps the place in the source that it came from, so each piece projects to the source bytes it
covers. The library segments the normalised text by the vocabulary; its own normalisation is switched off.

Defined results: null and empty texts have no ids and decode to the empty text; spans of a text are contiguous and end at its
length; what normalisation drops is covered by the piece before it; a character without a piece becomes its bytes' pieces.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hexwatch.llm.common import with_columns

SPACE = "▁"
#: Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def proto_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message; fixed-width values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class CharacterMap:
    """The compiled character map: longest known prefix of UTF-8 bytes and its replacement."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]
        self.first = frozenset(b for b in range(256) if self.units and self._child(self._offset(self.units[0]), b) is not None)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _child(self, node: int, byte: int) -> int | None:
        at = node ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, start: int) -> tuple[bytes, int] | None:
        """The replacement of the longest key at `start`, and the key's length."""
        if not self.units:
            return None
        node, best = self._offset(self.units[0]), None
        for n in range(start, len(data)):
            at = self._child(node, data[n])
            if at is None:
                break
            unit = self.units[at]
            node = at ^ self._offset(unit)
            if unit >> 8 & 1:
                best = self.units[node] & 0x7FFFFFFF, n + 1 - start
        if best is None:
            return None
        end = self.texts.index(0, best[0])
        return self.texts[best[0] : end], best[1]


class Piecewise:
    """A model file: normalisation with alignment, ids, spans, and decoding."""

    def __init__(self, path: str):
        import sentencepiece

        data = open(path, "rb").read()
        self.pieces, kinds, norm, trainer = [], [], {}, {}
        for field, value in proto_fields(data):
            if field == 1:
                piece = dict(proto_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer |= dict(proto_fields(value))
            elif field == 3:
                norm |= dict(proto_fields(value))
        if USER_DEFINED in kinds or trainer.get(24, 0):
            raise ValueError("models with user-defined symbols or white space as suffix are not supported")
        self.map = CharacterMap(norm.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.byte_of = {i: int(p[3:5], 16) for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.silent = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.unknown = {i for i, k in enumerate(kinds) if k == UNKNOWN}
        # The same model without normalisation segments words that are normalised here.
        plain = b"\x12\x00\x18\x00\x20\x00\x28\x00"
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=data + b"\x1a" + bytes([len(plain)]) + plain)
        self.shown = [str(i) for i in range(len(self.pieces))]
        self.raw = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else " ⁇ ".encode() if i in self.unknown else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.size = np.array([1 if i in self.byte_of or i in self.unknown else len(p.replace(SPACE, " ").encode()) for i, p in enumerate(self.pieces)], np.int64)
        self.mapped = re.compile("[" + "".join(re.escape(chr(b)) for b in sorted(self.map.first) if b < 128) + "\x80-\U0010ffff" * any(b > 127 for b in self.map.first) + "]") if self.map.first else None

    def plain(self, text: str) -> bool:
        """True if normalisation only marks spaces, one source byte each."""
        return not (
            SPACE in text or not self.escape or self.mapped is not None and self.mapped.search(text)
            or self.squeeze and ("  " in text or text.startswith(" ") or text.endswith(" "))
        )

    def normalise(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised bytes and, for each of them and the end, the source byte from which it came."""
        data = text.encode()
        out, align, at = bytearray(), [], 0
        mark = SPACE.encode() if self.escape else b" "

        def prefix(i: int) -> tuple[bytes, int]:
            if data[i] in self.map.first and (found := self.map.longest(data, i)):
                return found
            n = 1 if data[i] < 128 else 2 if data[i] < 224 else 3 if data[i] < 240 else 4
            return data[i : i + n], n

        if self.squeeze:
            while at < len(data):
                new, n = prefix(at)
                if new != b" ":
                    break
                at += n
        if at == len(data):
            return b"", [len(data)] if data else [0]
        if self.dummy:
            out += mark
            align += [at] * len(mark)
        spaced = self.squeeze
        while at < len(data):
            new, n = prefix(at)
            if spaced and self.squeeze:
                new = new.lstrip(b" ")
            for b in new:
                piece = mark if b == 32 else bytes([b])
                out += piece
                align += [at] * len(piece)
            if new:
                spaced = new.endswith(b" ")
            at += n
        align.append(at)
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                align[len(out) + 1 :] = []
                align[-1] = align[len(out)]
        return bytes(out), align

    def decode_bytes(self, ids: list[int]) -> bytes:
        raw = b"".join([self.raw[i] for i in ids])
        if self.squeeze:
            raw = raw.lstrip(b" ")
        elif self.dummy:
            first = next((i for i in ids if i not in self.silent), None)
            if first is not None and self.pieces[first].startswith(SPACE):
                raw = raw[1:]
        try:
            raw.decode()
        except UnicodeDecodeError:  # bytes that make no character
            return raw.decode(errors="replace").encode()
        return raw

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode()

    def ends_of(self, ids: np.ndarray, size: int) -> np.ndarray | None:
        """Where pieces end in a plain text of `size` bytes; None if an unknown piece hides a length."""
        ends = np.cumsum(self.size[ids]) - int(self.dummy)
        return ends if len(ends) and ends[-1] == size else None

    def aligned(self, ids: list[int], norm: bytes, align: list[int], size: int) -> np.ndarray:
        ends, at = [], 0
        for i in ids:
            if i in self.byte_of:
                at += 1
            elif i in self.unknown:
                n = norm[at]
                at += 1 if n < 128 else 2 if n < 224 else 3 if n < 240 else 4
            else:
                at += len(self.pieces[i].encode())
            ends.append(align[min(at, len(align) - 1)])
        if ends:
            ends[-1] = size
        return np.array(ends, np.int64)

    def encode(self, texts: list[str]) -> list[tuple[list[int], np.ndarray]]:
        """For each text its ids, and where each piece ends in its UTF-8 bytes; a piece begins where the one before it ends."""
        known: list[tuple[bytes, list[int]] | None] = []
        words = []
        for t in texts:
            if self.plain(t):
                known.append(None)
                words.append((SPACE if self.dummy and t else "") + t.replace(" ", SPACE))
            else:
                known.append(self.normalise(t))
                words.append(known[-1][0].decode())
        out = []
        for text, norm, ids in zip(texts, known, self.segmenter.encode(words)):
            size = len(text.encode())
            ends = self.ends_of(np.array(ids, np.int64), size) if norm is None else None
            if ends is None:
                norm = norm or self.normalise(text)
                ends = self.aligned(ids, norm[0], norm[1], size)
            out.append((ids, ends))
        return out

    def digests(self, texts: list[str]) -> list[tuple[int, str, str, int, int]]:
        """For each text: number of ids, hash of the ids, hash of the decoded text, checksum of the spans, bytes they cover."""
        shown = self.shown
        return [
            (len(ids), hashlib.sha256(",".join([shown[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(self.decode_bytes(ids)).hexdigest(),
             zlib.crc32(ends.astype("<i8").tobytes()), int(ends[-1]) if len(ends) else 0)
            for ids, ends in self.encode(texts)
        ]


_MODELS: dict[str, Piecewise] = {}


def model(path: str) -> Piecewise:
    """One model per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Piecewise(path)
    return _MODELS[path]


def groups(texts: pa.Array, most: int = 1 << 21) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    yield held


def digested(docs: DataFrame, path: str) -> DataFrame:
    """Per document: n_tokens, ids_sha256, decoded_sha256, and a checksum of the spans and the bytes they cover."""

    def make(texts: pa.Array) -> list[pa.Array]:
        rows = [r for g in groups(texts) for r in model(path).digests(g)]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]

    fields = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType(), "spans_crc32": T.LongType(), "span_bytes": T.LongType()}
    return with_columns(docs.select("doc_id", "text"), "text", fields, make).drop("text")


def encoded(docs: DataFrame, path: str, text: str = "text", into: tuple[str, str] = ("ids", "ends")) -> DataFrame:
    """Every row with its ids and the byte at which each piece ends in the source."""

    def make(texts: pa.Array) -> list[pa.Array]:
        pairs = [p for g in groups(texts) for p in model(path).encode(g)]
        return [pa.array([p[0] for p in pairs], pa.list_(pa.int32())), pa.array([p[1].tolist() for p in pairs], pa.list_(pa.int64()))]

    return with_columns(docs, text, {into[0]: T.ArrayType(T.IntegerType()), into[1]: T.ArrayType(T.LongType())}, make)
