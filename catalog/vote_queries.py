"""Votes, class scores and ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import data, model_sql, sql
from catalog.count_queries import r6
from catalog.registry import query
from catalog.search_queries import NEAR, POINT_SPLIT, _EUCLID, _VECTORS, dense_neighbours, near, near_euclid
from nearlex.operators import ensemble, votes

CLASSES = (1, 2, 3, 4)
_NO_ZERO = "nn WHERE sim > 0"


def _scores_sql(weight: str, rows: str = "nn") -> str:
    return f"sc AS MATERIALIZED (SELECT query_id, label, sum({weight}) AS score FROM {rows} GROUP BY query_id, label)"


_GRID = (
    "SELECT x.doc_id AS query_id, CAST(c AS INTEGER) AS label, round(coalesce(score, 0), {digits}) AS score "
    "FROM q x CROSS JOIN unnest([1, 2, 3, 4]) AS t(c) LEFT JOIN sc ON sc.query_id = x.doc_id AND sc.label = c"
)


def _decided(spark, sf, scores):
    asked = data.questions(spark, sf)
    return votes.for_all_queries(votes.decide(scores), asked, 1)


@query(sql.with_(*NEAR, _scores_sql("1")) + sql.decide("sc", "q"))
def y1_majority_vote(spark, sf):
    return _decided(spark, sf, votes.class_counts(near(spark, sf)))


@query(sql.with_(*NEAR, _scores_sql("pow(greatest(sim, 0), 2)")) + sql.decide("sc", "q"))
def y2_weighted_vote(spark, sf):
    return _decided(spark, sf, votes.class_scores(near(spark, sf), 2.0, None))


@query(sql.with_(*_VECTORS, sql.dots("s", "qw", "tw"), _EUCLID, _scores_sql("pow(1 / (sqrt(greatest(dist2, 0)) + 1e-9), 2)"))
       + _GRID.format(digits=3))
def y3_inverse_distance_scores(spark, sf):
    scores = votes.class_scores(near_euclid(spark, sf), 2.0)
    every = votes.with_all_classes(scores, data.questions(spark, sf), CLASSES)
    return every.select("query_id", "label", F.round("score", 3).alias("score"))


@query(sql.with_(*NEAR, _scores_sql("pow(greatest(sim, 0), 2)")) + _GRID.format(digits=6))
def y4_soft_class_scores(spark, sf):
    scores = votes.class_scores(near(spark, sf), 2.0, True)
    every = votes.with_all_classes(scores, data.questions(spark, sf), CLASSES)
    return every.select("query_id", "label", r6("score"))


@query("WITH " + POINT_SPLIT + """ SELECT query_id, label, round(sum(sim), 6) AS score FROM nn WHERE rank <= 101 GROUP BY query_id, label""")
def y5_unclamped_scores(spark, sf):
    found, _ = dense_neighbours(spark, sf)
    scores = votes.class_scores(found.filter("rank <= 101"), 1.0, None)
    return scores.select("query_id", "label", r6("score"))


@query("WITH " + POINT_SPLIT + """, sc AS (SELECT query_id, label, sum(pow(greatest(sim, 0), 2)) AS score FROM nn WHERE rank <= 31 GROUP BY query_id, label)
SELECT query_id, label AS pred FROM sc QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, label) = 1""")
def y6_argmax_class(spark, sf):
    found, _ = dense_neighbours(spark, sf)
    return votes.decide(votes.class_scores(found.filter("rank <= 31"), 2.0))


@query(sql.with_(*NEAR, "sc AS (SELECT query_id, label, sum(sim) AS score, min(rank) AS first FROM nn GROUP BY 1, 2)") + """SELECT query_id, label AS pred FROM sc
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, first) = 1""")
def y7_nearest_first_vote(spark, sf):
    return votes.decide(votes.nearest_first_scores(near(spark, sf)))


# -- ensembles: the preset of stemmed words to triples under two weightings, and characters -------

@data.shared
def members(spark, sf):
    docs, asked = data.documents(spark, sf), data.questions(spark, sf)
    held: dict = {}
    built = {name: data.ps.build(spec, docs, asked, held=held) for name, spec in data.ps.ENSEMBLE.items()}
    return {n: b.train for n, b in built.items()}, {n: b.queries for n, b in built.items()}


@data.shared
def member_scores(spark, sf):
    from nearlex.plans.classify import EnsembleClassifier
    from nearlex.session import stage

    fit, asked = members(spark, sf)
    return stage(EnsembleClassifier(11).fit(fit).member_scores(asked), "scores")


_TOKENS = {"bm25": model_sql.stemmed(3), "sublinear": model_sql.stemmed(3), "char": model_sql.CHARS_WB}
MEMBERS = (
    sql.ASKED,
    "r AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT '{name}' AS rep, * FROM ({model_sql.scores_sql(data.ps.ENSEMBLE[name], *tokens, power=2.0, digits=None)})"
        for name, tokens in _TOKENS.items()
    ) + ")",
)
_REP_WEIGHT = "(CASE rep WHEN 'char' THEN 0.6 WHEN 'lsi' THEN 0.4 ELSE 1.0 END)"
_SHARES = (
    "sh AS (SELECT rep, query_id, label, score / (CASE WHEN sum(score) OVER w = 0 THEN 1 ELSE sum(score) OVER w END) AS p FROM r WINDOW w AS (PARTITION BY rep, query_id)), "
    "hot AS (SELECT rep, query_id, label, pow(p, 2.0) AS p FROM sh), "
    "sharp AS MATERIALIZED (SELECT rep, query_id, label, p / (CASE WHEN sum(p) OVER w = 0 THEN 1 ELSE sum(p) OVER w END) AS p FROM hot WINDOW w AS (PARTITION BY rep, query_id))"
)
WEIGHTS = data.ps.ENSEMBLE_WEIGHTS


@query(sql.with_(*MEMBERS) + "SELECT rep, query_id, label, round(score, 6) AS score FROM r")
def e1_member_scores(spark, sf):
    return member_scores(spark, sf).select("rep", "query_id", "label", r6("score"))


@query(sql.with_(*MEMBERS, f"sc AS (SELECT query_id, label, sum({_REP_WEIGHT} * score) AS score FROM r GROUP BY 1, 2)")
       + sql.decide("sc", "q"))
def e2_weighted_soft_vote(spark, sf):
    return _decided(spark, sf, ensemble.weighted_sum(member_scores(spark, sf), WEIGHTS))


@query(sql.with_(*MEMBERS, f"sc AS (SELECT query_id, label, sum({_REP_WEIGHT} * score) AS score FROM r WHERE rep <> 'sublinear' GROUP BY 1, 2)")
       + sql.decide("sc", "q"))
def e3_representation_toggles(spark, sf):
    from nearlex.plans.classify import EnsembleClassifier

    fit, asked = members(spark, sf)
    on = [name for name in data.ps.enabled(sublinear=False)]
    model = EnsembleClassifier(11, rep_weights=WEIGHTS).fit({n: fit[n] for n in on})
    return model.predict({n: asked[n] for n in on})


@query(sql.with_(*MEMBERS, _SHARES) + f"SELECT query_id, label, round(sum({_REP_WEIGHT} * p), 6) AS score FROM sharp GROUP BY query_id, label")
def e4_temperature_sharpening(spark, sf):
    scores = ensemble.tempered_vote(member_scores(spark, sf), WEIGHTS, 2.0)
    return scores.select("query_id", "label", r6("score"))
