"""Documents from raw rows to token ids: quality rules, near-duplicates, personal data,
mixing and encoding.

Every stage gets all rows that the stage before it kept, written as Parquet and read
again. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlet.llm.bpe import encode_documents
from martlet.llm.common import table
from martlet.llm.mixing import mixed_documents
from martlet.llm.pii import redact
from martlet.llm.quality_rules import keep_good
from martlet.llm.queries import VOCABULARY
from martlet.llm.shingle_join import one_of_each
from martlet.session import fresh_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or the likelihood ratio."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each near-duplicate group."""
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; keeps every document."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents until each source has its target, some twice."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, source, ids, n_tokens and the digests of the
    ids and of the text decoded from them."""
    path = public_tokenizers.path(VOCABULARY)
    encoded = encode_documents(docs, path, public_tokenizers.PATTERN, keep_ids=True)
    return encoded.select(
        "doc.doc_id", "doc.lang", "doc.source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixing),
    ("byte-level BPE encoding and decoding", encoding),
]

#: Hash buckets, signatures and merges cannot be stated in SQL; the tests compare the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
