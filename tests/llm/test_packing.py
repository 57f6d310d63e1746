import zlib

import numpy as np
import pytest

from hexwatch.llm import packing


def placed(rows, capacity=1024):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_pieces_against_the_library(spark, sf, odd, path_of):
    from tokenizers import Tokenizer

    path = path_of("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).union(odd.select(odd["doc_id"] + 800000, "text"))
    special = spark.createDataFrame([(900001, "a<|endoftext|>b"), (900002, "it's 123  x\n\n y ")], docs.schema)
    rows = packing.pieces(docs.union(special), path).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.union(special).collect()}
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [2]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        if r["piece"]:
            assert r["length"] == 1024
    assert {r["doc_id"] for r in rows} == set(texts)


RUNS = [" ", "\n", "\t", " \n", "\u3000 ", "\x85\xa0", "\x1c"]


@pytest.mark.parametrize("run", RUNS)
@pytest.mark.parametrize("before, after", [("", ""), ("a", "b"), ("one ", "\n"), ("x.", "<|endoftext|> y"), ("", "!"), ("a\n", "'s"), ("é", "\t日")])
def test_long_runs_of_white_space_as_the_library(path_of, run, before, after):
    from tokenizers import Tokenizer

    path = path_of("byte_bpe_50k.json")
    ours, library = packing.ByteBpe(path), Tokenizer.from_file(path)
    for n in (packing.LONG_RUN - 1, packing.LONG_RUN, 3 * packing.LONG_RUN + 1):
        text = f"{before}{run * n}{after} middle {run * n}{after}"
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_runs_that_the_pattern_could_not_cut(spark, docs_of, path_of):
    texts = [" " * 1_200_000 + "end", "\n" * 1_100_000, "ab" + " \n\t" * 400_000 + "x"]
    from tokenizers import Tokenizer

    path = path_of("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs_of(list(enumerate(texts))), path).collect()
    placed(rows)
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        own = sorted((r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i)
        assert sum(n for _, n, _ in own) == len(ids)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in own)


def test_ten_million_spaces(path_of):
    ids = packing.ByteBpe(path_of("byte_bpe_50k.json")).encode(" " * 10_000_000)
    assert len(ids) == 10_000_000 and len(set(ids[:9].tolist())) == 1


def test_packing_is_tight_and_whole(spark, sf, path_of):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack_documents(docs, path_of("byte_bpe_50k.json")).collect()
    bins = placed(rows)
    tokens = sum(r["length"] for r in rows)
    assert len(bins) <= 1.02 * -(-tokens // 1024) + 1
    whole = packing.pieces(docs, path_of("byte_bpe_50k.json"))
    assert len(rows) == whole.count() and tokens == whole.agg({"length": "sum"}).first()[0]


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 200, 600)
    limits = np.array([512.0, 6.0, 60000.0])
    bins, offsets = packing.best_fit(lengths, limits, np.ones(3), rule)
    for b in set(bins.tolist()):
        own = lengths[bins == b]
        assert own.sum() <= 512 and len(own) <= 6 and (own**2).sum() <= 60000
        order = np.argsort(offsets[bins == b])
        assert (offsets[bins == b][order] == np.concatenate(([0], np.cumsum(own[order])[:-1]))).all()
    with pytest.raises(ValueError):
        packing.best_fit(np.array([600]), limits, np.ones(3))


def test_blocks_split_one_document_and_repeated_rows(spark, docs_of, path_of):
    docs = docs_of([(1, "same words again"), (1, "same words again"), (2, "long text " * 9000), (None, None)])
    cut = packing.pieces(docs, path_of("byte_bpe_50k.json"))
    rows = packing.pack(cut, block=5).collect()
    placed(rows)
    assert len(rows) == cut.count()
    assert [r["length"] for r in rows if r["doc_id"] is None] == [1]


def test_empty(empty, path_of):
    assert packing.pack_documents(empty, path_of("byte_bpe_50k.json")).count() == 0


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(4, 4) == [(0, 4)]
