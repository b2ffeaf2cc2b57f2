"""Feature selection, reduction, neighbours and feedback."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import data, sql
from catalog.count_queries import r6
from catalog.registry import query
from nearlex.functions import expressions as ex
from nearlex.operators import (
    feedback, lsi, neighbours as nb, selection, splits, threshold, vectors as vx,
)
from nearlex.plans import presets as ps
from nearlex.plans.classify import NeighbourClassifier
from nearlex.session import stage

_VECTORS = sql.word_vectors()
_CHI2 = (*_VECTORS, sql.chi2("c", "tw", "d"))


@data.shared
def term_scores(spark, sf):
    return stage(selection.chi2_scores(data.word_features(spark, sf).train), "chi2")


@query(sql.with_(*_CHI2) + "SELECT term, round(chi2, 6) AS chi2 FROM c")
def x1_chi2_scores(spark, sf):
    vocab = data.word_features(spark, sf).vocab
    scores = term_scores(spark, sf).join(vocab.select("term_id", "term"), "term_id")
    return scores.select("term", r6("chi2"))


@query(sql.with_(*_CHI2) + "SELECT term FROM c ORDER BY round(chi2, 6) DESC, term LIMIT 2000")
def x2_top_terms(spark, sf):
    vocab = data.word_features(spark, sf).vocab
    return selection.best_terms(term_scores(spark, sf), vocab, 2000).select("term")


@data.shared
def selected_features(spark, sf):
    fitted = data.word_features(spark, sf)
    return selection.select_features(fitted.train, fitted.vocab, 2000, fitted.queries)


@query(sql.with_(*_CHI2, sql.selected("ts", "tw", "c", 2000),
                 f"qs_raw AS (SELECT * FROM qw SEMI JOIN ts_top USING (term)), qs AS ({sql.unit('qs_raw')})")
       + "SELECT 'train' AS side, doc_id, term, round(w, 6) AS w FROM ts UNION ALL "
         "SELECT 'query', doc_id, term, round(w, 6) FROM qs")
def x3_select_and_renormalise(spark, sf):
    vocab = data.word_features(spark, sf).vocab
    train, asked = selected_features(spark, sf)
    sides = [
        vx.named_entries(v, vocab).select(F.lit(side).alias("side"), "doc_id", "term", r6("w"))
        for side, v in (("train", train), ("query", asked))
    ]
    return sides[0].unionByName(sides[1])


@data.shared
def components(spark, sf):
    return lsi.fit_components(selected_features(spark, sf)[0], 20)


@query()
def x4_truncated_svd(spark, sf):
    values = components(spark, sf).singular_values
    rows = [(i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "component int, singular_value double")


@query()
def x5_project(spark, sf):
    train, asked = selected_features(spark, sf)
    fitted = components(spark, sf)
    dense = lsi.project(train.drop("label"), fitted).select(F.lit("train").alias("side"), "*")
    other = lsi.project(asked, fitted).select(F.lit("query").alias("side"), "*")
    return dense.unionByName(other).select(
        "side", "doc_id", F.posexplode("vec").alias("component", "value")
    ).withColumn("value", F.round("value", 6))


@query()
def x6_explained_variance(spark, sf):
    train, _ = selected_features(spark, sf)
    raw = lsi.project(train, components(spark, sf), normalise=False)
    return lsi.explained_variance(train, raw)


@query(sql.with_(*_VECTORS, sql.dots("s", "qw", "tw"))
       + "SELECT query_id, train_id, round(dot, 6) AS sim FROM s WHERE round(dot, 6) >= 0.1")
def k1_sparse_cosine(spark, sf):
    fitted = data.word_features(spark, sf)
    # Half a digit below, for similarities that round up to the threshold.
    pairs = threshold.similar(fitted.queries, fitted.train, 0.1 - 5.1e-7)
    return pairs.select("query_id", "train_id", r6("sim", F.col("dot"))).filter("sim >= 0.1")


_EUCLID = (
    "qn AS (SELECT q.doc_id, coalesce(sum(w * w), 0) AS sq FROM q LEFT JOIN qw USING (doc_id) GROUP BY q.doc_id), "
    "tn AS (SELECT d.doc_id, any_value(label) AS label, coalesce(sum(w * w), 0) AS sq FROM d LEFT JOIN tw USING (doc_id) GROUP BY d.doc_id), "
    "e AS MATERIALIZED (SELECT qn.doc_id AS query_id, tn.doc_id AS train_id, tn.label, "
    "round(greatest(qn.sq + tn.sq - 2 * coalesce(dot, 0), 0), 6) AS dist2 FROM qn CROSS JOIN tn "
    "LEFT JOIN s ON s.query_id = qn.doc_id AND s.train_id = tn.doc_id), "
    "nn AS MATERIALIZED (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist2, train_id) AS INTEGER) AS rank FROM e "
    "QUALIFY rank <= 11)"
)


@data.shared
def near_euclid(spark, sf):
    fitted = data.word_features(spark, sf)
    return stage(nb.nearest(fitted.queries, fitted.train, 11, metric="euclidean"), "nn")


@query(sql.with_(*_VECTORS, sql.dots("s", "qw", "tw"), _EUCLID)
       + "SELECT query_id, train_id, dist2, rank FROM nn")
def k2_sparse_euclidean(spark, sf):
    found = near_euclid(spark, sf)
    return found.select("query_id", "train_id", (F.col("dist2") + 0.0).alias("dist2"), "rank")


POINT_SPLIT = """p AS MATERIALIZED (SELECT vec_id AS doc_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) - 1 AS r, count(*) OVER () AS n FROM embeddings),
u AS MATERIALIZED (SELECT doc_id, label, r >= floor(0.8 * n) AS is_val,
list_transform(v, lambda x: x / greatest(sqrt(list_sum(list_transform(v, lambda y: y * y))), 1e-300)) AS v FROM p),
s AS MATERIALIZED (SELECT a.doc_id AS query_id, b.doc_id AS train_id, b.label, a.label AS truth, round(list_inner_product(a.v, b.v), 6) AS sim
FROM u a JOIN u b ON a.is_val AND NOT b.is_val),
nn AS MATERIALIZED (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, train_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 301)"""


@data.shared
def dense_neighbours(spark, sf):
    """Neighbours (up to 301) of the held-out fifth of the dense vectors."""
    unit = data.points(spark, sf).withColumn("vec", ex.unit_dense(F.col("vec")))
    split = stage(splits.random_split(unit, 0.8), "points")
    fit = split.filter(~F.col("is_val")).drop("is_val")
    val = split.filter("is_val").drop("is_val")
    truth = val.select(F.col("doc_id").alias("query_id"), F.col("label").alias("truth"))
    return stage(nb.nearest(val.drop("label"), fit, 301), "dense-nn"), truth


@query("WITH " + POINT_SPLIT + " SELECT query_id, train_id, label, sim, rank FROM nn WHERE rank <= 11")
def k3_dense_cosine(spark, sf):
    found, _ = dense_neighbours(spark, sf)
    return found.filter("rank <= 11").select("query_id", "train_id", "label", "sim", "rank")


@data.shared
def near(spark, sf):
    """The 11 nearest documents of every question, zero-filled."""
    fitted = data.word_features(spark, sf)
    return stage(nb.nearest(fitted.queries, fitted.train, 11), "nn")


NEAR = (*_VECTORS, sql.dots("s", "qw", "tw"), sql.nearest("nn", "s", "d", 11, "q"))


@query(sql.with_(*NEAR) + "SELECT query_id, train_id, label, sim, rank FROM nn")
def k4_top_k(spark, sf):
    return near(spark, sf).select("query_id", "train_id", "label", "sim", "rank")


@query(sql.with_(*NEAR, "sc AS (SELECT query_id, label, count(*) AS score FROM nn GROUP BY 1, 2)")
       + sql.decide("sc", "q"))
def k6_fit_predict(spark, sf):
    fitted = data.word_features(spark, sf)
    return NeighbourClassifier(11).fit(fitted.train).predict(fitted.queries)


def _expanded_sql(k: int, blend: str) -> str:
    neighbours = sql.nearest("nn", "s", "d", k, "q")
    mixed = (
        f"z AS (SELECT query_id, sum(sim) AS total FROM nn GROUP BY query_id), "
        f"m_raw AS (SELECT doc_id, term, sum(w) AS w FROM ({blend}) GROUP BY doc_id, term), "
        f"m AS ({sql.unit('m_raw')})"
    )
    return sql.with_(*_VECTORS, sql.dots("s", "qw", "tw"), neighbours, mixed) + (
        "SELECT doc_id, term, round(w, 6) AS w FROM m"
    )


def _named_queries(spark, sf, expanded):
    vocab = data.word_features(spark, sf).vocab
    return vx.named_entries(expanded, vocab).select("doc_id", "term", r6("w"))


@query(_expanded_sql(10, "SELECT doc_id, term, 0.8 * w AS w FROM qw UNION ALL "
                         "SELECT query_id, term, 0.2 / 10 * w FROM nn JOIN tw ON tw.doc_id = train_id"))
def r1_uniform_feedback(spark, sf):
    fitted = data.word_features(spark, sf)
    return _named_queries(spark, sf, feedback.expand_uniform(fitted.queries, fitted.train))


@query(_expanded_sql(10, "SELECT doc_id, term, 0.9 * w AS w FROM qw UNION ALL "
                         "SELECT query_id, term, 0.1 * sim / greatest(total, 1e-9) * w FROM nn JOIN z USING (query_id) "
                         "JOIN tw ON tw.doc_id = train_id WHERE sim > 0"))
def r2_weighted_feedback(spark, sf):
    fitted = data.word_features(spark, sf)
    return _named_queries(spark, sf, feedback.expand_weighted(fitted.queries, fitted.train))
