"""A corpus in five stages: toxic documents go, one document of each group of near copies stays, documents that hold benchmark
passages go, secrets are redacted, and what is left is encoded as tokens.

Each stage reads what the one before it wrote, and decides from that alone (and from `labels` and `benchmark`). All but
the last return the columns of the documents as they are. A row with null text is kept by every stage and has no tokens; an
empty table gives an empty one; extra columns, whatever their names, go through the first four stages untouched. Very long texts are
worked on whole. Repeated rows with words are copies of each other, of which `drop_near_copies` keeps one; ties go to the smallest id.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import bpe, decontaminate, jaccard, secrets, toxicity
from vitrine.llm.rows import table
from vitrine.workspace import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones of `documents`, doesn't predict toxic."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_ordinary(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (sets of five words, 80% in common) the one with the smallest id; documents without words all stay."""
    return jaccard.first_of_each(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, ids_sha256, decoded_sha256) of every document."""
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    encoded = bpe.round_trip(docs.select("doc_id", "text"), path, ids=True)
    return encoded.select("doc_id", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

#: Trained classifiers and merging can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"{name}-{uuid.uuid4().hex[:8]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
