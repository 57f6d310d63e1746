from collections import Counter

import corpus_pipeline
from hexwatch.llm.common import stored


def test_stages_keep_columns_and_reject_only_what_they_should(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "secret_scan", "best_fit_packing"]
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.collect()}
        docs = stored(stage(spark, docs, sf), name)
        assert docs.columns == columns
        lost = before - {r["doc_id"] for r in docs.collect()}
        if name == "quality_rules":
            assert sum(quality.get(d, 0) for d in lost) <= 0.05 * sum(quality.values())
        if name == "secret_scan":
            assert not lost
    assert Counter(r["doc_id"] for r in docs.collect()).most_common(1)[0][1] == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_odd_and_empty_documents(spark, odd, empty):
    extra = odd.withColumnRenamed("n_chars", "score")
    for docs in (extra, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, ""), name)
        docs.count()


def test_stages_bound_the_batches(spark):
    """A stage alone has the package's settings: batches for Python end by bytes, not only by rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, "1g")
    docs = spark.createDataFrame([(1, "text", "en", "s", 4)], "doc_id long, text string, lang string, source string, n_chars int")
    dict(corpus_pipeline.STAGES)["secret_scan"](spark, docs, "")
    assert spark.conf.get(key) == "4m"
