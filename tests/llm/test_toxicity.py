import pytest
from pyspark.sql import functions as F

from hexwatch.llm import toxicity
from hexwatch.llm.queries import QUERIES

NEUTRAL = "the weather in the village was calm and the market opened early near the river with bread and fruit".split()


def labelled(spark):
    """Toxic sentences that often name one group, so that a plain classifier learns the group's name."""
    rows = []
    for k in range(400):
        words = [NEUTRAL[(k * 7 + i * (k % 5 + 1)) % len(NEUTRAL)] for i in range(14)]
        toxic = k % 4 == 0
        if toxic:
            words[3:5] = ["muslim", "scumbag"] if k % 8 == 0 else ["muslim", "vermin"]
        elif k % 40 == 1:
            words[3] = "christian"
        rows.append((" ".join(words) + ".", int(toxic), 1.0))
    return spark.createDataFrame(rows, "text string, toxic int, weight double")


def test_counterfactuals_free_group_names(spark):
    data = labelled(spark)
    probe = spark.createDataFrame([(1, "a muslim opened the market early"), (2, "the vermin opened the market"), (3, "a muslim scumbag near the river"), (4, "the market opened early")], "doc_id long, text string")

    def scores(strength):
        return {r["doc_id"]: r["score"] for r in toxicity.score(probe, toxicity.fit(data, strength)).collect()}

    plain, fair = scores(0.0), scores(20.0)
    assert plain[1] >= toxicity.THRESHOLD > fair[1]  # a neutral mention
    assert fair[2] > 0.5 and fair[3] > 0.5
    assert abs(fair[1] - fair[4]) < abs(plain[1] - plain[4])


def plain_pairs(text, kept):
    """Every counterfactual from whole sentences, one by one."""
    out = []
    for m in toxicity.SENTENCE.finditer(text.lower()):
        for t in toxicity.TERM.finditer(m[0]):
            for other in toxicity.SWAPS[t[1]]:
                a, b = (set(x.split()) & kept for x in (m[0], m[0][: t.start()] + other + m[0][t.end() :]))
                out.append((tuple(sorted(a - b)), tuple(sorted(b - a))))
    return out


def test_swaps_stay_in_their_kind():
    text = "One muslim came. A WOMAN left! a muslim and a hindu . " + "the hindu came. " * 70
    kept = {"muslim", "hindu", "man", "came"}
    pairs, made = toxicity.Counterfactuals(lambda words: [kept & {w} for w in words]).of(text)
    expected = [p for p in plain_pairs(text, kept) if p != ((), ())]
    assert sum(pairs.values()) == len(expected) and set(pairs) == set(expected)  # all sentences count, without a cap
    assert made == 7 * 73 + 3
    assert (("muslim",), ("hindu",)) in pairs and ((), ("man",)) in pairs and not any("man" in a and "muslim" in b for a, b in pairs)


def test_terms_are_put_into_sentences_without_any():
    text = "the scumbag walked through that village. " * 3 + "some other people went there. " + " ".join(f"word{i} walked there." for i in range(200))
    pairs, made = toxicity.Counterfactuals(lambda words: [{w[:4]} & {"scum", "musl", "gay", "blac"} for w in words]).of(text)
    assert made > 600 and pairs and all(not plus for plus, _ in pairs)  # an ordinary word went, a term came
    assert not any("scum" in minus for _, minus in pairs)


def test_neutral_mentions_with_and_without_the_penalty(spark):
    """False positive rates over a table of neutral mentions, most of terms and frames that the labelled rows do not hold."""
    data = labelled(spark)
    frames = ["a {} opened the market early", "the {} family lives near the river", "my {} neighbour brought bread and fruit", "she met a {} teacher in the village"]
    terms = toxicity.IDENTITY_TERMS["en", "religion"] + ["muslims"]
    probe = spark.createDataFrame([(k, f.format(t)) for k, (f, t) in enumerate((f, t) for f in frames for t in terms)], "doc_id long, text string")
    rate = {}
    for strength in (0.0, toxicity.COUNTERFACTUAL):
        model = toxicity.fit(data, strength)
        assert model.differing > 100 and model.made > model.differing
        rate[strength] = toxicity.score(probe, model).agg(F.avg("predicted")).first()[0]
    assert rate[0.0] > 0.1 and rate[toxicity.COUNTERFACTUAL] <= 0.03


@pytest.mark.parametrize("fold", [False, True])
def test_query_accuracy(spark, fold):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op2_toxicity_counterfactual"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(F.col("held_out") == fold).collect()
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hit >= 0.9 * sum(r["toxic"] for r in rows)
    assert sum(r["predicted"] == 1 and r["toxic"] == 0 for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_odd_texts_and_labels(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0), (3, 0)], "doc_id long, toxic int")
    rows = {r["doc_id"]: r["toxic"] for r in toxicity.sampled(labels).collect()}
    assert rows == {1: 1, 3: 0}
    none = toxicity.fit(spark.createDataFrame([], "text string, toxic int, weight double"))
    assert {r["predicted"] for r in toxicity.score(odd.drop("n_chars"), none).collect()} == {0}
    model = toxicity.fit(labelled(spark))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert scored[0] == scored[1] == scored[2]
    assert toxicity.score(empty, model).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("toxic"))
    rows = toxicity.sampled(labels, 30, 50).collect()
    assert sum(r["toxic"] for r in rows) == 30 and len(rows) == 80
    assert abs(sum(r["weight"] for r in rows if r["toxic"]) - 100) < 1e-6


def test_copies_of_a_sampled_id_are_one_row(spark):
    docs = spark.createDataFrame([(1, "a")] * 50 + [(2, "b"), (2, "c"), (2, "b"), (3, "x"), (4, None), (4, None)], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 1, 2.0), (2, 0, 3.0), (4, 0, 1.0)], "doc_id long, toxic int, weight double")
    rows = sorted(((r["text"] or "", r["toxic"], r["weight"]) for r in toxicity.labelled_texts(docs, chosen).collect()))
    assert rows == [("", 0, 1.0), ("a", 1, 2.0), ("b", 0, 1.5), ("c", 0, 1.5)]
