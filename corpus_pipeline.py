"""From raw documents to token ids: filter, identify, deduplicate, mix, encode.

Every stage takes (spark, docs, sf_dir), with ``docs`` the table its predecessor
kept.  All but the last return the columns of ``documents``; the last returns
the ids of the tokens instead of the text, decoded again to a digest.

Edge cases: null and empty texts are rejected by language ID; a null lang, source
or id and repeated rows pass as any other row, except that of near-duplicates one
stays.  Very long texts are worked on whole.  An empty table stays empty.  Extra
columns are kept up to the last stage, which returns its own.  Ties are settled
by the stages' operators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from nearlex.llm import bpe, language, mixing, quality, simhash
from nearlex.llm.base import table
from nearlex.session import checkpoint_root

#: No SQL gives these rows: the classifiers, BK-trees and tokenizer are not SQL.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised."""
    return language.recognised(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.survivors(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the bytes decoded from them."""
    import public_tokenizers

    return bpe.encode(
        docs.select("doc_id", "lang", "source", "text"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
        outputs=("ids", "n_tokens", "decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mixing_sources),
    ("byte-level BPE encoding and decoding", byte_level_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
