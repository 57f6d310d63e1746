import hashlib
import struct

import pytest
import sentencepiece as library
from hypothesis import given, settings
from hypothesis import strategies as st

from hexwatch.llm import sentencepiece
from hexwatch.llm.queries import QUERIES

TEXTS = st.text(st.sampled_from("ab Z.  \n\t▁é日😀ﬁ①　́㌔﷽\x00\x7f") | st.characters(exclude_categories=["Cs"]), max_size=40)


@pytest.fixture(scope="module")
def pair():
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.Piecewise(path), library.SentencePieceProcessor(model_file=path)


def test_query_against_the_library(spark, sf, pair):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_sentencepiece_offsets"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = pair[1].encode(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(pair[1].decode(ids).encode()).hexdigest()
        assert r["span_bytes"] == len((texts[r["doc_id"]] or "").encode())


@settings(max_examples=150, deadline=None)
@given(text=TEXTS)
def test_any_text(pair, text):
    ours, theirs = pair
    (ids, ends), = ours.encode([text])
    assert ids == theirs.encode(text) and ours.decode(ids) == theirs.decode(ids)
    data, at = text.encode(), 0
    assert len(ends) == len(ids) and sorted(ends) == list(ends) and (not ids or ends[-1] == len(data))
    for i, end in zip(ids, ends):  # pieces without byte fallback show what they cover
        if i not in ours.byte_of and "▁" not in text and at:
            assert ours.raw[i] == data[at:end]
        at = end


def test_decoding_of_any_ids(pair):
    ours, theirs = pair
    for ids in ([], [3, 4, 5], [1, 5, 2], [29871, 29871], [230, 10, 40000 % 32000], [0], [259, 259], [195, 172], [240, 162, 155, 131, 300], [5, 200, 6]):
        assert ours.decode(ids) == theirs.decode(ids)


@pytest.fixture(scope="module")
def rules():
    return library.SentencePieceNormalizer(rule_name="nmt_nfkc")


def character_map(normalizer):
    spec = normalizer.serialized_normalizer_spec()
    return sentencepiece.CharacterMap(dict(sentencepiece.proto_fields(spec))[2])


@settings(max_examples=150, deadline=None)
@given(text=TEXTS)
def test_compiled_map_against_the_library(rules, text):
    piecewise = object.__new__(sentencepiece.Piecewise)
    piecewise.map = character_map(rules) if not hasattr(rules, "_map") else rules._map
    rules._map = piecewise.map
    piecewise.dummy, piecewise.squeeze, piecewise.escape = True, True, True
    norm, align = piecewise.normalise(text)
    assert norm.decode() == rules.normalize(text)
    assert len(align) == len(norm) + 1 and align == sorted(align) and align[-1] <= len(text.encode())


def test_longest_key_wins():
    """A map by hand: `a` becomes `x`, `ab` becomes `yz`."""
    unit = lambda label, offset, leaf: offset << 10 | leaf << 8 | label
    units = [0] * 1024
    units[0] = unit(0, 256, 0)
    units[256 ^ 97] = unit(97, 512 ^ 256 ^ 97, 1)
    units[512] = 0 | 1 << 31
    units[512 ^ 98] = unit(98, 768 ^ 512 ^ 98, 1)
    units[768] = 2 | 1 << 31
    blob = struct.pack("<I", 4096) + struct.pack("<1024I", *units) + b"x\0yz\0"
    found = sentencepiece.CharacterMap(blob)
    assert [found.longest(t, 0) for t in (b"ac", b"abc", b"b")] == [(b"x", 1), (b"yz", 2), None]


def test_odd_texts(odd, empty, path_of):
    path = path_of("piece_bpe_32k.model")
    rows = {r["doc_id"]: r for r in sentencepiece.encoded(odd, path).collect()}
    assert rows[0]["ids"] == [] == rows[1]["ids"] and rows[10]["ends"][-1] == 20000
    assert sentencepiece.digested(odd, path).count() == odd.count()
    assert sentencepiece.digested(empty, path).count() == 0
