import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hexwatch.llm import tokencounts

FILES = ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"]
LONG = ["one two  three\n\n   four é日本 \t" * 400, " " * 5000, "x" * 5000, "▁a ▁ b" * 900, "<s>a</s><|endoftext|> " * 300, "😀‍🚀 ñ́" * 500, "a\x00b\x85c\xa0 " * 500]


def library_counts(path, texts):
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        return [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    return [len(library.encode(t)) for t in texts]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("part_chars, call_bytes", [(7, 50), (100, 1000), (1 << 16, 1 << 20)])
def test_parts_count_as_the_whole(path_of, name, part_chars, call_bytes):
    path = path_of(name)
    texts = [*LONG, "", "a", *LONG[:2]]
    found = tokencounts.lengths_of(pa.array(texts), tokencounts.counter(path), part_chars, call_bytes)
    assert found.tolist() == library_counts(path, texts)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab e▁ \n\t　é日😀'.1<|s>\x00"), max_size=60), st.integers(1, 9))
def test_any_cut_is_safe(text, size):
    import public_tokenizers

    for name in FILES[:2]:
        path = public_tokenizers.path(name)
        assert tokencounts.lengths_of(pa.array([text]), tokencounts.counter(path), size, 40).tolist() == library_counts(path, [text])


def test_long_texts_are_cut(path_of):
    counts = tokencounts.counter(path_of("piece_bpe_32k.model"))
    parts = counts.split("some words in a row " * 2000, 1000)
    assert len(parts) > 35 and max(map(len, parts)) < 1100
    assert len(counts.split("x" * 5000, 1000)) == 1  # no boundary
    assert not tokencounts.counter(path_of("word_bpe_49k.json")).cuts


def test_calls_are_balanced_by_bytes():
    import numpy as np

    calls = []

    def measure(texts):
        calls.append(sum(len(t.encode()) for t in texts))
        return [len(t) for t in texts]

    totals = np.zeros(3, np.int64)
    tokencounts.in_calls([(i % 3, "é" * 20) for i in range(30)], measure, totals, 100)
    assert totals.tolist() == [200] * 3 and max(calls) <= 100 and len(calls) == 15


@pytest.mark.parametrize("name", FILES)
def test_table(spark, sf, odd, path_of, name):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(odd.select(odd["doc_id"] + 900000, "text"))
    rows = tokencounts.counted(docs, path_of(name), limit=300).collect()
    texts = [r["text"] or "" for r in rows]
    assert [r["n_tokens"] for r in rows] == library_counts(path_of(name), texts)
    assert [r["n_bytes"] for r in rows] == [len(t.encode()) for t in texts]
    assert all(r["over_limit"] == (r["n_tokens"] > 300) for r in rows) and len(rows) == docs.count()


def test_clashing_names_and_empty(spark, docs_of, empty, path_of):
    path = path_of("piece_bpe_32k.model")
    docs = docs_of([(1, "two words")]).selectExpr("doc_id", "text", "'x' as N_TOKENS", "'y' as over_limit", "array(1) as `odd.name`")
    out = tokencounts.counted(docs, path)
    assert out.columns == ["doc_id", "text", "odd.name", "n_bytes", "n_tokens", "over_limit"]
    assert out.first()["n_tokens"] == 2
    assert tokencounts.counted(empty, path).count() == 0


def test_query(spark, sf, path_of):
    from hexwatch.llm.queries import op11_token_counts

    out = op11_token_counts(spark, sf)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert "Exchange" not in out._jdf.queryExecution().toString()
