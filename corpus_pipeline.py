"""Corpus pipeline: quality, near-dedup, PII, mixing, tokens, each stage on what the last one kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes each stage's result to the shared folder and
reads it back, so a lost executor costs no more than the stage it was in.

Defined results: every stage passes null texts, repeated rows and further columns as its
operator states; an empty table gives empty results throughout. The mix repeats a
document as often as it takes it, and every repeat is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm.bpe import token_digests
from quern.llm.common import prepare, staged, table
from quern.llm.mixing import mix_documents
from quern.llm.pii import replace_pii
from quern.llm.quality import keep_good
from quern.llm.simhash import drop_near_copies


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the classifier rejects go."""
    prepare(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group stays, that with the smallest doc_id."""
    prepare(spark)
    return drop_near_copies(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: personal data replaced by surrogates."""
    prepare(spark)
    return replace_pii(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents as often as the mix of sources takes them."""
    prepare(spark)
    return mix_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token count and digests of every document."""
    prepare(spark)
    return token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality_classifier), ("simhash near-dedup", simhash_near_dedup), ("pii", pii),
          ("mixing sources to target weights", mixing), ("bpe encoding and decoding", bpe)]
# Fitted scores, hashes of shingles and merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
