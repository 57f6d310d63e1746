"""One query per operator over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.llm import conversations, fingerprints, language, neardup, packing, quality, secrets, sentencepiece, tokencounts, toxicity, urls, vectorcodes, warc
from hexwatch.llm.common import held_out, stored, table
from hexwatch.session import shared_dir


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write(warc.records(table(spark, sf_dir, "pages")), path)
    kinds = F.col("record_type").isin("response", "revisit")
    return warc.digests(warc.read(spark, path).where(kinds))


OP1_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (select payload_digest, min(page_id) as page from p where payload_bytes >= 100 group by payload_digest)
select p.page_id, p.payload_bytes, p.payload_digest,
       case when f.page is not null and f.page <> p.page_id then 'revisit' else 'response' end as record_type,
       case when f.page <> p.page_id then f.page end as refers_to
from p left join f on p.payload_digest = f.payload_digest and p.payload_bytes >= 100
"""


def op2_toxicity_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chosen = toxicity.sampled(table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic"))
    found = toxicity.score(docs, toxicity.fit(toxicity.labelled_texts(docs, chosen)))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_language_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = language.learn(docs.where(~held_out()).select("text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = stored(quality.metrics(docs).drop("text"), "quality-figures")
    return quality.judged(measured).select("doc_id", *quality.FIGURES, "base_failed", "kept")


def op5_sentencepiece_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digested(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, urls.fit(urls.labelled_urls(spark))).select("page_id", "host", "path", "rule", "verdict", "score")


def op10_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.class_of_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.counted(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model")).drop("text")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compressed(table(spark, sf_dir, "embeddings"))


def _op12_sql(parts: int = vectorcodes.PARTS, entries: int = vectorcodes.ENTRIES, rounds: int = vectorcodes.ROUNDS) -> str:
    """Plain Lloyd rounds: every part against every entry of its codebook."""

    def nearest(k: int) -> str:
        return f"""
a{k} as materialized (
  select vec_id, part, min(row(far, entry)) as best from (
    select p.vec_id, p.part, c.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))::bigint as far
    from p join c{k} c using (part)
  ) group by vec_id, part
)"""

    def means(k: int) -> str:
        return f"""
m{k} as (
  select part, entry, list(floor_mean order by i) as x from (
    select p.part, a.best[2] as entry, i, floor(sum(p.x[i]) / count(*))::bigint as floor_mean
    from p join a{k} a using (vec_id, part), (select unnest(range(1, (select max(len(x)) from p) + 1)) as i) group by 1, 2, 3
  ) group by part, entry
), c{k + 1} as materialized (select part, entry, coalesce(m.x, c.x) as x from c{k} c left join m{k} m using (part, entry))"""

    steps = ",".join(nearest(k) + "," + means(k) for k in range(rounds)) + "," + nearest(rounds)
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor({vectorcodes.SCALE} * x)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as materialized (
  select vec_id, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] as x from kept, (select unnest(range({parts})) as part)
), c0 as materialized (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, x from p
  where vec_id in (select vec_id from kept order by vec_id limit {entries})
),{steps}, done as (
  select vec_id, string_agg(printf('%02x', best[2]), '' order by part) as code, sum(best[1])::bigint as error from a{rounds} group by vec_id
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) from c{rounds}) as codebooks_sha256
from done join kept using (vec_id)
"""


OP12_SQL = _op12_sql()


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_toxicity_counterfactual": op2_toxicity_counterfactual,
    "op3_language_bloom": op3_language_bloom,
    "op4_quality_rules": op4_quality_rules,
    "op5_sentencepiece_offsets": op5_sentencepiece_offsets,
    "op6_improbable_features": op6_improbable_features,
    "op7_secret_scan": op7_secret_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_url_filter": op9_url_filter,
    "op10_weighted_minhash": op10_weighted_minhash,
    "op11_token_counts": op11_token_counts,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES: dict[str, str] = {"op1_warc": OP1_SQL, "op12_vector_codes": OP12_SQL}
