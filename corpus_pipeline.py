"""Preparation of a text corpus: language ID, quality rules, near duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next stage's documents.
All stages take empty tables, repeated rows, each judged for itself, texts of any length as a whole, and further columns of any name,
which the first four keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hexwatch.llm import language, neardup, packing, quality, secrets
from hexwatch.llm.common import column, fresh, held_out, stored
from hexwatch.llm.queries import tokenizer_path
from hexwatch.session import apply_defaults

#: A document of which the best language explains less than this share of the n-grams is rejected.
MIN_LANGUAGE_SHARE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; nothing is learned from the held-out fold.

    Null and empty texts, and texts without letters, have no language and go; null languages are not learned from; of equally
    likely languages the first in order is taken; without any known language all documents go.
    """
    filters = language.learn(docs.where(~held_out()).select("text", "lang"))
    names = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    found = language.identify(docs, filters, into=names)
    known = (column(found, names[0]) != language.UNKNOWN) & (column(found, names[1]) >= MIN_LANGUAGE_SHARE)
    return found.where(known).drop(*names)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their group's limits.

    Null and empty texts have no words and go; null language or source are groups of their own; texts at a limit stay.
    """
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least id.

    Of several rows of that id one stays; null and empty texts are one class; null ids come last.
    """
    return neardup.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; null texts stay null, overlapping spans become one mark."""
    return secrets.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null or empty text is one piece with the end id; equal pieces are packed each for itself; other columns are left behind.
    """
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))



def _configured(stage):
    """The stage under the settings that the package relies on, as its operator's query has them."""
    return lambda spark, docs, sf_dir: stage(apply_defaults(spark), docs, sf_dir)


STAGES = [(f.__name__, _configured(f)) for f in (language_id, quality_rules, near_duplicates, secret_scan, best_fit_packing)]

#: Models, sketches, signatures and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
