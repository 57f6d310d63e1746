import numpy as np
from hexwatch.llm import language
from hexwatch.llm.common import held_out
from hexwatch.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf):
    rows = QUERIES["op3_language_bloom"](spark, sf).alias("p").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    got = [(r["lang_pred"], r["lang"], r["score"]) for r in rows.where("held_out and lang is not null").collect()]
    assert len(got) > 20
    assert sum(p == t for p, t, _ in got) >= 0.97 * len(got)
    assert all(0 <= s <= 1 for *_, s in got)


def test_counts_against_sets():
    sets = [np.array([1, 2, 3, 500], np.int64), np.array([3, 4], np.int64), np.zeros(0, np.int64)]
    filters = language.SlicedFilters(["a", "b", "c"], sets, "a")
    mask = filters.masks(np.array([1, 3, 4, 77], np.uint32))[0]
    assert mask.tolist() == [1, 3, 2, 0]
    assert (filters.false_rate < 0.01).all()


def test_grams_stay_inside_texts():
    from hexwatch.llm.common import text_bytes
    import pyarrow as pa

    def plain(text):
        kept = " " + "".join(c if c.isalpha() else " " for c in text) + " "
        grams = [kept[i : i + 4] for i in range(len(kept) - 3)]
        return [g for g in grams if "  " not in g]

    texts = ["ab cd", "", "x", "hello, world", "--"]
    g, before = language.grams(*text_bytes(pa.array(texts)))
    found = ["".join(chr(int(v) >> s & 255) for s in (24, 16, 8, 0)) for v in g]
    for k, t in enumerate(texts):
        assert found[before[k] : before[k + 1]] == plain(t)


def test_more_languages_than_a_word_holds():
    sets = [np.array([k, k + 1000], np.int64) for k in range(70)]
    filters = language.SlicedFilters([f"l{k:02d}" for k in range(70)], sets, "l00")
    words = filters.masks(np.array([69, 3], np.uint32))
    assert int(words[1][0]) >> (69 - 64) & 1 and int(words[0][1]) >> 3 & 1


def test_odd_texts(odd, empty, docs_of):
    learned = language.learn(docs_of([(1, "the cat sat on the mat and the dog", "en", None), (2, "der hund und die katze auf dem tisch", "de", None)]).unionByName(docs_of([(3, None, "fr", None), (4, "x", None, None)])))
    assert learned.languages == ["de", "en"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd, learned).collect()}
    for i in (0, 1, 2, 3, 5):
        assert got[i] == ("und", 0.0)
    assert got[6][0] in ("de", "en")  # letters, but nothing known
    assert language.identify(empty, learned).count() == 0


def test_nothing_to_learn(empty, odd):
    got = language.identify(odd, language.learn(empty)).select("lang_pred").distinct().collect()
    assert [r[0] for r in got] == ["und"]


def test_held_out_fold(docs_of):
    import zlib

    rows = docs_of([(i, "t") for i in range(40)]).select("doc_id", held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_names_that_exist_are_replaced(odd):
    out = language.identify(odd.withColumnRenamed("source", "Score"), language.SlicedFilters([], [], None))
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score"]


def test_copies_change_neither_sample_nor_filters(spark, docs_of):
    plain = docs_of([(k, f"the ordinary words of text {'abcdefghij'[k % 10] * 5} and its neighbour", "en", None) for k in range(200)] + [(1000, "der hund und die katze", "de", None)]).select("text", "lang")
    copied = spark.range(40_000).selectExpr("repeat('qux zyx ', 60) as text", "'en' as lang")
    once, often = (language.learn(plain.unionByName(x)) for x in (copied.limit(1), copied))
    assert once.languages == often.languages and (once.words == often.words).all()
