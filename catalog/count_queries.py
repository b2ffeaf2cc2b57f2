"""Counts, vocabularies and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import data, sql
from catalog.registry import query
from nearlex.functions import expressions as ex
from nearlex.operators import bags as bg, ensemble, vectors as vx
from nearlex.operators.vocabulary import fit_vocabulary
from nearlex.plans import presets as ps

_WORDS = sql.with_(*sql.words())


def r6(name: str, column=None):
    """Round for comparison; adding zero turns -0.0 into 0.0."""
    return (F.round(F.col(name) if column is None else column, 6) + F.lit(0.0)).alias(name)


@query(_WORDS + "SELECT count(*) AS n_docs, count(*) FILTER (len(toks) = 0) AS n_empty FROM dt")
def a1_corpus_size(spark, sf):
    bag = data.word_bags(spark, sf)
    return bag.agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("dl") == 0).alias("n_empty")
    )


@query(_WORDS + "SELECT doc_id, term, tf FROM tf")
def a2_term_frequency(spark, sf):
    return bg.term_frequencies(data.word_bags(spark, sf)).select("doc_id", "term", "tf")


@query(_WORDS + "SELECT term, count(*) AS df FROM tf GROUP BY term")
def a3_document_frequency(spark, sf):
    return bg.document_frequencies(data.word_bags(spark, sf)).select("term", "df")


@query(sql.with_(*sql.words(2)) + "SELECT doc_id, CAST(len(toks) AS INTEGER) AS dl FROM dt")
def a4_document_length(spark, sf):
    docs = data.documents(spark, sf)
    return bg.tokenised(docs, bg.rich_analyzer(2, normaliser=None)).select(
        "doc_id", F.size("tokens").alias("dl")
    )


@query(_WORDS + "SELECT round(avgdl, 6) AS avgdl FROM st")
def a5_average_length(spark, sf):
    bag = data.word_bags(spark, sf)
    return bag.agg(r6("avgdl", F.coalesce(F.avg("dl"), F.lit(1.0))))


@query(_WORDS + "SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 3")
def a6_min_df_filter(spark, sf):
    counts = bg.document_frequencies(data.word_bags(spark, sf))
    return counts.filter(F.col("df") >= 3).select("term", "df")


_LETTERS = sql.with_(*sql.words(expression=sql.LETTERS))


@query(_LETTERS + "SELECT term, count(*) AS df FROM tf, st GROUP BY term HAVING count(*) <= 0.95 * any_value(n)")
def a7_max_df_filter(spark, sf):
    bag = data.letter_bags(spark, sf)
    n, _ = bg.corpus_stats(bag)
    return bg.document_frequencies(bag).filter(F.col("df") <= 0.95 * n).select("term", "df")


@query(_WORDS.rstrip() + ", " + sql.vocab("tf", cap=5_000) + " SELECT term, df FROM v")
def a8_vocabulary_cap(spark, sf):
    bag = data.word_bags(spark, sf)
    vocab = fit_vocabulary(bag, bg.corpus_stats(bag)[0], max_terms=5_000)
    return vocab.select("term", "df")


@query(_LETTERS.rstrip() + ", " + sql.vocab("tf", cap=5_000, by="total") + " SELECT term, total FROM v")
def a9_cap_by_total_count(spark, sf):
    bag = data.letter_bags(spark, sf)
    vocab = fit_vocabulary(bag, bg.corpus_stats(bag)[0], max_terms=5_000, cap_by="total")
    return bg.document_frequencies(bag).join(vocab.select("term"), "term").select("term", "total")


@query(_WORDS.rstrip() + ", " + sql.vocab("tf") + " SELECT term, CAST(term_id AS INTEGER) AS term_id FROM v")
def a10_term_index(spark, sf):
    return data.word_features(spark, sf).vocab.select("term", "term_id")


@query(_WORDS.rstrip() + ", " + sql.vocab("tf") + " SELECT term, round(idf, 6) AS idf FROM v")
def a11_idf_bm25(spark, sf):
    return data.word_features(spark, sf).vocab.select("term", r6("idf"))


@query(_WORDS.rstrip() + ", " + sql.vocab("tf", "smooth") + " SELECT term, round(idf, 6) AS idf FROM v")
def a12_idf_smooth(spark, sf):
    return data.sublinear_features(spark, sf).vocab.select("term", r6("idf"))


@query(sql.with_(*sql.words(2), sql.vocab("tf", cap=150_000))
       + "SELECT term, CAST(term_id AS INTEGER) AS term_id, df, round(idf, 6) AS idf FROM v")
def a13_fitted_vocabulary(spark, sf):
    tokens = bg.tokenised(data.documents(spark, sf), bg.rich_analyzer(2, normaliser=None))
    bag = bg.bags(tokens)
    vocab = fit_vocabulary(bag, bg.corpus_stats(bag)[0], min_df=2, max_terms=150_000)
    return vocab.select("term", "term_id", "df", r6("idf"))


def _weights_sql(weight: str, rows: str = "tw", **kw) -> str:
    return sql.with_(*sql.word_vectors(weight, **kw)) + (
        f"SELECT doc_id, term, round(w, 6) AS w FROM {rows}"
    )


def _named(vectors, vocab):
    return vx.named_entries(vectors, vocab).select("doc_id", "term", r6("w"))


@query(_weights_sql("bm25"))
def w1_bm25_weights(spark, sf):
    fitted = data.word_features(spark, sf)
    return _named(fitted.train, fitted.vocab)


@query(_weights_sql("sublinear"))
def w2_sublinear_weights(spark, sf):
    fitted = data.sublinear_features(spark, sf)
    return _named(fitted.train, fitted.vocab)


_SIMPLE_TOKENS = f"list_filter({sql.LETTERS}, lambda t: NOT list_contains({sql.STOP_LIST}, t))"


@query(sql.with_(*sql.words(expression=_SIMPLE_TOKENS),
                 sql.vocab("tf", "smooth", cap=None, max_df=0.95, by="total"),
                 sql.weights("tw", "dt", "tf", "tfidf"))
       + "SELECT doc_id, term, round(w, 6) AS w FROM tw")
def w3_standard_tfidf(spark, sf):
    fitted = ps.build(ps.SIMPLE, data.documents(spark, sf))
    return _named(fitted.train, fitted.vocab)


@query(sql.with_(*sql.word_vectors()) + "SELECT d.doc_id, round(coalesce(sqrt(sum(w * w)), 0), 6) AS norm "
       "FROM d LEFT JOIN tw USING (doc_id) GROUP BY d.doc_id")
def w4_sparse_row_norm(spark, sf):
    train = data.word_features(spark, sf).train
    square = F.aggregate("vec", F.lit(0.0), lambda acc, e: acc + e["w"] * e["w"])
    return train.select("doc_id", r6("norm", F.sqrt(square)))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM e)
SELECT vec_id AS doc_id, CAST(i - 1 AS INTEGER) AS position, round(v[i] / (CASE WHEN norm = 0 THEN 1 ELSE norm END), 6) AS value
FROM s, unnest(range(1, len(v) + 1)) AS r(i)""")
def w5_dense_row_norm(spark, sf):
    unit = data.points(spark, sf).select("doc_id", ex.unit_dense(F.col("vec")).alias("vec"))
    return unit.select("doc_id", F.posexplode("vec").alias("position", "value")).select(
        "doc_id", "position", r6("value")
    )


@query(sql.with_(*sql.words()) + """SELECT doc_id, term, round(tf / sum(tf) OVER (PARTITION BY doc_id), 6) AS share FROM tf""")
def w6_row_share(spark, sf):
    rows = bg.term_frequencies(data.word_bags(spark, sf)).select(
        F.lit("tf").alias("rep"), F.col("doc_id").alias("query_id"), "term",
        F.col("tf").cast("double").alias("score"),
    )
    return ensemble.shares(rows).select(
        F.col("query_id").alias("doc_id"), "term", r6("share", F.col("score"))
    )


@query(_weights_sql("bm25", "qw"))
def w7_transform_with_fitted_stats(spark, sf):
    fitted = data.word_features(spark, sf)
    return _named(fitted.queries, fitted.vocab)
