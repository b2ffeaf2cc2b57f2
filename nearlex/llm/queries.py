"""Registered queries of this package and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nearlex.llm import alignment, bpe, collocations, hmm, language, mixing, pagetext, postings, quality, rules, simhash, sketch, urlgraph
from nearlex.llm.base import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.query(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(table(spark, sf_dir, "documents"))


def op4_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path(RANKS), public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.PATTERN,
    )


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return postings.search(rows, rows.filter("vec_id % 100 = 0"), 10)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_url_graph, op3_mixing, op4_sketch, op5_html, op6_simhash, op7_rules, op8_bpe,
        op9_language, op10_hidden_markov, op11_alignment, op12_neighbours, op13_collocations,
    )
}
ORACLES: dict[str, str] = {"op3_mixing": mixing.SQL, "op13_collocations": collocations.SQL}
