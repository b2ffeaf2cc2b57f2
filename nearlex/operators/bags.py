"""Documents to term counts: one row per document, empty documents kept."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearlex.functions import porter, text as tx
from nearlex.functions.stopwords import ENGLISH
from nearlex.operators.rowjoin import matched
from nearlex.session import BROADCAST_LIMIT_BYTES, bound_batches, collected_if_small, spread, stage

Analyzer = Callable[[Column], Column]


def simple_analyzer(
    stop_words: Sequence[str] | None = ENGLISH, normaliser: Analyzer | None = None
) -> Analyzer:
    """Letter runs, optional stop-word removal, optional stemming."""

    def analyse(text: Column) -> Column:
        tokens = tx.letter_runs(text)
        if stop_words:
            tokens = tx.drop_words(tokens, stop_words)
        return normaliser(tokens) if normaliser else tokens

    return analyse


def rich_analyzer(
    max_order: int = 3,
    stop_words: Sequence[str] = ENGLISH,
    normaliser: Analyzer | None = porter.stem,
) -> Analyzer:
    """Stripped words without stop words or single letters, stemmed, with n-grams."""

    def analyse(text: Column) -> Column:
        words = tx.split_words(tx.strip_punctuation(text))
        tokens = tx.drop_short(tx.drop_words(words, stop_words))
        if normaliser:
            tokens = normaliser(tokens)
        return tx.with_ngrams(tokens, max_order)

    return analyse


def tokenised(docs: DataFrame, analyzer: Analyzer, text_col: str = "text") -> DataFrame:
    """Replace the text column by ``tokens``; narrow unless the input is one split."""
    bound_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != text_col]
    return spread(docs, *keep[:1]).select(*keep, analyzer(F.col(text_col)).alias("tokens"))


def normalised_by_table(
    tokens: DataFrame,
    table: DataFrame,
    token_col: str = "token",
    form_col: str = "lemma",
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Replace each token by its form in ``table``; a missing token stays itself.

    Of several forms of a token the smallest counts.  A table under ``limit``
    bytes is looked up inside the row, by batches of dictionary-encoded tokens; a
    larger one is shuffle-joined, with the rows of a frequent token dealt over
    parts, and gives the same rows.
    """
    keep = [c for c in tokens.columns if c != "tokens"]
    forms = stage(
        table.select(F.col(token_col).alias("_tok"), F.col(form_col).alias("_form"))
        .filter(F.col("_tok").isNotNull() & F.col("_form").isNotNull())
        .groupBy("_tok").agg(F.min("_form").alias("_form")),
        "forms",
    )
    known = collected_if_small(forms, "_tok", "_form", limit=limit)
    if known is not None:
        return _replaced_in_row(tokens, known, keep)
    # Tokens are written first: a join reads them twice.
    hits = matched(stage(tokens.select(*keep, "tokens"), "tokens"), "tokens", lambda t: t, forms, "_tok")
    words = F.transform("hits", lambda h: F.coalesce(h["_hit"]["_form"], h["_item"]))
    return hits.select(*keep, words.alias("tokens"))


def _replaced_in_row(tokens: DataFrame, known: pa.Table, keep: list[str]) -> DataFrame:
    sent = tokens.sparkSession.sparkContext.broadcast(known.combine_chunks())
    rows = tokens.select(*keep, "tokens")

    def run(batches):
        words, forms = (sent.value.column(c).combine_chunks() for c in ("_tok", "_form"))
        for batch in batches:
            lists = batch.column("tokens")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            coded = pc.list_flatten(lists).dictionary_encode()
            at = pc.index_in(coded.dictionary, value_set=words)
            spelled = pc.coalesce(forms.take(at), coded.dictionary).take(coded.indices)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.ListArray.from_arrays(offsets, spelled)], names=[*keep, "tokens"]
            )

    return rows.mapInArrow(run, rows.schema)


def bags(tokens: DataFrame, name: str = "bags") -> DataFrame:
    """Stage ``doc_id, ..., dl, terms`` where ``dl`` counts every token.

    ``terms`` is ``array<struct<term, tf>>``.  Everything later (vocabulary,
    averages, weights) reads this table, so the text is tokenised once.
    """
    keep = [c for c in tokens.columns if c != "tokens"]
    counts = tokens.select(*keep, tx.counted_with_length(F.col("tokens")).alias("_counts"))
    return stage(counts.select(*keep, "_counts.dl", "_counts.terms"), name)


def term_frequencies(bag: DataFrame) -> DataFrame:
    """Long form: one row per document and term."""
    keep = [c for c in bag.columns if c != "terms"]
    return bag.select(*keep, F.inline("terms"))


def corpus_stats(bag: DataFrame) -> tuple[int, float]:
    """Number of documents and average length, empty documents included."""
    row = bag.agg(F.count(F.lit(1)), F.avg("dl")).first()
    return int(row[0]), float(row[1]) if row[1] is not None else 1.0


def document_frequencies(bag: DataFrame) -> DataFrame:
    """Documents per term and total count per term, combined before the shuffle."""
    return (
        bag.select(F.inline("terms"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    )
