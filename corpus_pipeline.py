"""Cleaning pipeline over ``documents``: toxicity, near-duplicates, benchmark passages, secrets, token ids.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of docs.

Cases: rows with a null text pass every filter and encode to no ids; rows with a null id are never linked to
others; rows that repeat id and text are copies of which one stays; an empty table passes through all stages;
extra columns are kept, but for those named ``token_ids``, ``n_tokens`` or ``exact``, which the last stage replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm import bpe, decontaminate, ngram_join, secret_scan, toxicity
from martpulse.llm.common import Scratch, read
from martpulse.llm.queries import BPE_VOCABULARY, WORD_VOCABULARY


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    chain = toxicity.train(spark, docs.select("doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return toxicity.reject(spark, docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by 5-word Jaccard similarity of 0.8 or more, the one with the least id stays."""
    return ngram_join.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go."""
    return decontaminate.remove_documents(spark, docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked."""
    return secret_scan.redact(spark, docs, secret_scan.dictionary_of(spark, WORD_VOCABULARY))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it exactly."""
    out = bpe.BpeTokenizer(spark, BPE_VOCABULARY).encode(docs, exact="exact")
    return out.select(*[c for c in docs.columns if c not in ("token_ids", "n_tokens", "exact")], "token_ids",
                      F.size("token_ids").cast("long").alias("n_tokens"), "exact")


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

#: Trained models decide rows: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, last = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs, path = scratch.put(stage(spark, docs, sf_dir))
        if last:
            scratch.drop(last)
        last = path
    return docs
