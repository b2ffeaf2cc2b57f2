"""Splits, metrics, sweeps and weight search."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import data, sql
from catalog.count_queries import r6
from catalog.registry import query
from catalog.search_queries import POINT_SPLIT, dense_neighbours
from nearlex.operators import bags as bg, ensemble, metrics, neighbours as nb, splits, sweeps, votes
from nearlex.operators.vocabulary import fit_vocabulary
from nearlex.plans import classify as cl, presets as ps
from nearlex.session import stage


def _holdout_sql(name: str = "ho", docs: str = "d") -> str:
    return (
        f"{name}_c AS (SELECT label, count(*) AS c, sum(count(*)) OVER () AS n FROM {docs} GROUP BY label), "
        f"{name}_f AS (SELECT *, n - ceil(0.1 * n) AS n_fit, c * (n - ceil(0.1 * n)) / n AS exact FROM {name}_c), "
        f"{name}_q AS (SELECT label, c - floor(exact) - CAST(row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, label) "
        f"<= n_fit - sum(floor(exact)) OVER () AS INTEGER) AS quota FROM {name}_f), "
        f"{name} AS MATERIALIZED (SELECT doc_id, d.label, row_number() OVER (PARTITION BY d.label ORDER BY md5('42:' || doc_id), doc_id) <= quota AS is_val "
        f"FROM {docs} d JOIN {name}_q USING (label))"
    )


@query(sql.with_(sql.DOCS, _holdout_sql()) + "SELECT doc_id, label, is_val FROM ho")
def v1_stratified_holdout(spark, sf):
    return splits.stratified_holdout(data.documents(spark, sf).select("doc_id", "label"))


_SPLIT = "sp AS MATERIALIZED (SELECT doc_id, label, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 >= floor(0.8 * count(*) OVER ()) AS is_val FROM d)"


@query(sql.with_(sql.TURNS, _SPLIT) + "SELECT doc_id, label, is_val FROM sp")
def v2_random_split(spark, sf):
    return splits.random_split(data.turns(spark, sf).select("doc_id", "label"))


_QUICK = (
    "sp AS MATERIALIZED (SELECT doc_id, label, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 >= "
    "(count(*) OVER () * 10000) // 12000 AS is_val FROM d)"
)


@query(sql.with_(sql.TURNS, _QUICK) + "SELECT doc_id, label, is_val FROM sp")
def v3_quick_search_split(spark, sf):
    return splits.quick_search_split(data.turns(spark, sf).select("doc_id", "label"))


def _turn_vectors(weight: str = "bm25", split: str = _SPLIT, k: int = 41) -> tuple[str, ...]:
    """Turns, split, vectors fitted on all turns, filled neighbours of the held-out part."""
    idf = "bm25" if weight == "bm25" else "smooth"
    return (
        *sql.words(docs=sql.TURNS), split, sql.vocab("tf", idf), sql.weights("w", "dt", "tf", weight),
        *_split_sides("w", k),
    )


def _split_sides(rows: str, k: int, tag: str = "") -> tuple[str, ...]:
    return (
        f"f{tag} AS MATERIALIZED (SELECT {rows}.* FROM {rows} JOIN sp USING (doc_id) WHERE NOT is_val)",
        f"x{tag} AS MATERIALIZED (SELECT {rows}.* FROM {rows} JOIN sp USING (doc_id) WHERE is_val)",
        f"fd{tag} AS (SELECT doc_id, label FROM sp WHERE NOT is_val)",
        f"xd{tag} AS (SELECT doc_id, label AS truth FROM sp WHERE is_val)",
        sql.dots(f"s{tag}", f"x{tag}", f"f{tag}"),
        sql.nearest(f"nn{tag}", f"s{tag}", f"fd{tag}", k, f"xd{tag}"),
    )


@data.shared
def turn_split(spark, sf):
    docs = data.turns(spark, sf).select("doc_id", "label")
    return stage(splits.random_split(docs), "turn-split")


@data.shared
def turn_truth(spark, sf):
    return turn_split(spark, sf).filter("is_val").select(
        F.col("doc_id").alias("query_id"), F.col("label").alias("truth")
    )


@data.shared
def turn_features_of(spark, sf, weight):
    spec = data.WORDS if weight == "bm25" else data.SUBLINEAR
    return ps.build(spec, data.turns(spark, sf))


@data.shared
def turn_neighbours(spark, sf, weight):
    fit, val = splits.parts(turn_features_of(spark, sf, weight).train, turn_split(spark, sf))
    return stage(nb.nearest(val.drop("label"), fit, 41), "turn-nn")


_WEIGHTED = "sc AS (SELECT query_id, label, sum(pow(greatest(sim, 0), 2)) AS score FROM nn WHERE rank <= 11 GROUP BY 1, 2)"
_JUDGED = f"j AS (SELECT truth, pred FROM xd JOIN ({sql.decide('sc', 'xd')}) ON query_id = doc_id)"


@query(sql.with_(*_turn_vectors(), _WEIGHTED, _JUDGED)
       + f"SELECT round(macro_f1, 6) AS macro_f1 FROM ({sql.macro_f1('j')})")
def v4_macro_f1(spark, sf):
    found = turn_neighbours(spark, sf, "bm25").filter("rank <= 11")
    decided = votes.decide(votes.class_scores(found, 2.0, None))
    judged = sweeps.judged(decided, turn_truth(spark, sf), 1)
    return metrics.macro_f1(judged).select(r6("macro_f1"))


@query(sql.with_(*_turn_vectors(), _WEIGHTED, _JUDGED)
       + "SELECT truth, pred, count(*) AS n FROM j GROUP BY truth, pred")
def v4_confusion(spark, sf):
    found = turn_neighbours(spark, sf, "bm25").filter("rank <= 11")
    decided = votes.decide(votes.class_scores(found, 2.0, None))
    return metrics.confusion(sweeps.judged(decided, turn_truth(spark, sf), 1))


_HOLD = _holdout_sql("sp")


@query(sql.with_(*_turn_vectors(split=_HOLD, k=11), _WEIGHTED, _JUDGED)
       + f"SELECT round(macro_f1, 6) AS macro_f1 FROM ({sql.macro_f1('j')})")
def v5_holdout_validation(spark, sf):
    features = {"bm25": turn_features_of(spark, sf, "bm25").train}
    return cl.holdout_f1(features, k=11).select(r6("macro_f1"))


_REFIT = (
    sql.TURNS, _HOLD, "fdoc AS (SELECT d.doc_id, d.label, text FROM d JOIN sp USING (doc_id) WHERE NOT is_val)",
    "q AS (SELECT d.doc_id, text FROM d JOIN sp USING (doc_id) WHERE is_val)",
    sql.tokens("dt", "fdoc", sql.RAW_WORDS), sql.counts("tf", "dt"), sql.stats("dt"), sql.vocab("tf"),
    sql.weights("f", "dt", "tf"), sql.tokens("qt", "q", sql.RAW_WORDS, label=False), sql.counts("qf", "qt"),
    sql.weights("x", "qt", "qf"), "xd AS (SELECT doc_id, label AS truth FROM sp WHERE is_val)",
    sql.dots("s", "x", "f"), sql.nearest("nn", "s", "fdoc", 11),
)


@query(sql.with_(*_REFIT, _WEIGHTED, _JUDGED)
       + f"SELECT round(macro_f1, 6) AS macro_f1 FROM ({sql.macro_f1('j')})")
def v5_refitted_validation(spark, sf):
    return cl.refitted_holdout_f1(data.turns(spark, sf), data.WORDS, k=11).select(r6("macro_f1"))


def _sweep_sql(ks, nn: str = "nn", xd: str = "xd", name: str = "") -> tuple[str, ...]:
    listed = "[" + ", ".join(map(str, ks)) + "]"
    return (
        f"ks{name} AS (SELECT unnest({listed}) AS k)",
        f"sc{name} AS (SELECT k, query_id, label, sum(sim) AS score, min(rank) AS first FROM {nn} JOIN ks{name} ON rank <= k GROUP BY ALL)",
        f"j{name} AS (SELECT k, truth, label AS pred FROM (SELECT * FROM sc{name} QUALIFY row_number() OVER (PARTITION BY k, query_id "
        f"ORDER BY round(score, 9) DESC, first) = 1) JOIN {xd} ON doc_id = query_id)",
        f"r{name} AS MATERIALIZED ({sql.macro_f1(f'j{name}', 'k')})",
    )


@query(sql.with_(*_turn_vectors(), *_sweep_sql(sweeps.K_SPARSE))
       + "SELECT CAST(k AS INTEGER) AS k, round(macro_f1, 6) AS macro_f1 FROM r")
def v6_k_sweep(spark, sf):
    found = turn_neighbours(spark, sf, "bm25")
    scored = sweeps.k_sweep(found, turn_truth(spark, sf), sweeps.K_SPARSE, 1)
    return scored.select("k", r6("macro_f1"))


@query("WITH " + POINT_SPLIT + ", "
       + "xd AS (SELECT doc_id, label AS truth FROM u WHERE is_val), "
       + ", ".join(_sweep_sql(sweeps.K_DENSE)) + " SELECT CAST(k AS INTEGER) AS k, round(macro_f1, 6) AS macro_f1 FROM r")
def v6_dense_k_sweep(spark, sf):
    found, truth = dense_neighbours(spark, sf)
    return sweeps.k_sweep(found, truth, sweeps.K_DENSE, 0).select("k", r6("macro_f1"))


def _grid_sql() -> str:
    parts = [*sql.words(docs=sql.TURNS), _QUICK, sql.vocab("tf", cap=200_000)]
    rows = []
    for i, (k1, b) in enumerate((k1, b) for k1 in sweeps.K1_GRID for b in sweeps.B_GRID):
        parts.append(sql.weights(f"g{i}", "dt", "tf", k1=k1, b=b))
        parts += _split_sides(f"g{i}", 11, f"g{i}")
        parts += _sweep_sql([11], f"nng{i}", f"xdg{i}", f"g{i}")
        rows.append(f"SELECT CAST({k1} AS DOUBLE) AS k1, CAST({b} AS DOUBLE) AS b, round(macro_f1, 6) AS macro_f1 FROM rg{i}")
    return sql.with_(*parts) + " UNION ALL ".join(rows)


@query(_grid_sql())
def v7_bm25_grid(spark, sf):
    bag = bg.bags(bg.tokenised(data.turns(spark, sf), ps.analyzer(data.WORDS)))
    n, avgdl = bg.corpus_stats(bag)
    vocab = fit_vocabulary(bag, n, max_terms=200_000)
    split = stage(splits.quick_search_split(data.turns(spark, sf).select("doc_id", "label")), "quick")
    scored = sweeps.bm25_grid(bag, vocab, split, avgdl, 1)
    return scored.select("k1", "b", r6("macro_f1"))


# -- two representations of the same split ---------------------------------------------------------

def _two(k: int = 11) -> tuple[str, ...]:
    return (
        *sql.words(docs=sql.TURNS), _SPLIT, sql.vocab("tf", "bm25", name="vb"), sql.vocab("tf", "smooth", name="vs"),
        sql.weights("wb", "dt", "tf", "bm25", v="vb"), sql.weights("ws", "dt", "tf", "sublinear", v="vs"),
        *_split_sides("wb", k, "b"), *_split_sides("ws", k, "s"),
    )


_BOTH = "SELECT 'bm25' AS rep, * FROM nnb UNION ALL SELECT 'sublinear', * FROM nns"
FIXED = {"bm25": 1.0, "sublinear": 0.8}


@data.shared
def both_neighbours(spark, sf):
    tables = [
        turn_neighbours(spark, sf, name).withColumn("rep", F.lit(name)) for name in FIXED
    ]
    return tables[0].unionByName(tables[1])


def _power_temperature_sql() -> str:
    return sql.with_(
        *_two(), f"nn AS ({_BOTH})", "pw AS (SELECT unnest([1.0, 2.0, 3.0, 5.0]::DOUBLE[]) AS power)",
        "tp AS (SELECT unnest([1.0, 1.5, 2.0, 3.0]::DOUBLE[]) AS temperature)",
        "raw AS (SELECT power, rep, query_id, label, sum(CASE WHEN power = 1 THEN sim ELSE pow(greatest(sim, 0), power) END) AS s FROM nn, pw GROUP BY ALL)",
        "sh AS (SELECT *, s / (CASE WHEN sum(s) OVER w = 0 THEN 1 ELSE sum(s) OVER w END) AS p FROM raw WINDOW w AS (PARTITION BY power, rep, query_id))",
        "hot AS (SELECT power, temperature, rep, query_id, label, pow(greatest(p, 0), temperature) AS p FROM sh, tp)",
        "fin AS (SELECT *, p / (CASE WHEN sum(p) OVER w = 0 THEN 1 ELSE sum(p) OVER w END) AS share FROM hot WINDOW w AS (PARTITION BY power, temperature, rep, query_id))",
        "sc AS (SELECT power, temperature, query_id, label, sum(CASE rep WHEN 'bm25' THEN 1.0 ELSE 0.8 END * share) AS score FROM fin GROUP BY ALL)",
        "best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY power, temperature, query_id ORDER BY round(score, 9) DESC, label) = 1)",
        "j AS (SELECT power, temperature, truth, label AS pred FROM best JOIN xdb ON doc_id = query_id)",
    ) + f"SELECT power, temperature, round(macro_f1, 6) AS macro_f1 FROM ({sql.macro_f1('j', 'power, temperature')})"


@query(_power_temperature_sql())
def v8_power_temperature_grid(spark, sf):
    found = both_neighbours(spark, sf).filter("rank <= 11")
    scored = sweeps.power_temperature_grid(found, turn_truth(spark, sf), FIXED, 1)
    return scored.select("power", "temperature", r6("macro_f1"))


_COMPARED = (
    *_two(41), *_sweep_sql(sweeps.K_SPARSE, "nnb", "xdb", "b"), *_sweep_sql(sweeps.K_SPARSE, "nns", "xds", "s"),
    "best AS MATERIALIZED (SELECT * FROM (SELECT 'bm25' AS model, * FROM rb UNION ALL SELECT 'sublinear', * FROM rs) "
    "QUALIFY row_number() OVER (PARTITION BY model ORDER BY round(macro_f1, 9) DESC, k) = 1)",
)


@data.shared
def best_ks(spark, sf):
    scored = sweeps.k_sweep(
        both_neighbours(spark, sf), _truth_per_model(spark, sf), sweeps.K_SPARSE, 1, ["rep"]
    )
    return stage(sweeps.best_setting(scored, ["k"], ["rep"]), "best-k")


def _truth_per_model(spark, sf):
    names = F.explode(F.array(*[F.lit(n) for n in FIXED])).alias("rep")
    return turn_truth(spark, sf).select("*", names)


@query(sql.with_(*_COMPARED) + "SELECT model, CAST(k AS INTEGER) AS k, round(macro_f1, 6) AS macro_f1 FROM best")
def v9_model_comparison(spark, sf):
    return best_ks(spark, sf).select(F.col("rep").alias("model"), "k", r6("macro_f1"))


@query(sql.with_(
    *_COMPARED, "nn AS (SELECT a.* , macro_f1 AS weight FROM (" + _BOTH + ") a JOIN best ON model = rep AND rank <= k)",
    "raw AS (SELECT rep, weight, query_id, label, sum(sim) AS s FROM nn GROUP BY ALL)",
    "sh AS (SELECT *, s / (CASE WHEN sum(s) OVER w = 0 THEN 1 ELSE sum(s) OVER w END) AS p FROM raw WINDOW w AS (PARTITION BY rep, query_id))",
) + "SELECT query_id, label, round(sum(weight * p), 6) AS score FROM sh GROUP BY query_id, label")
def e5_f1_weighted_ensemble(spark, sf):
    best = best_ks(spark, sf)
    found = both_neighbours(spark, sf).join(F.broadcast(best.select("rep", "k")), "rep")
    scores = votes.class_scores(found.filter("rank <= k"), 1.0, None, ["rep"])
    weights = {r["rep"]: r["macro_f1"] for r in best.collect()}
    combined = ensemble.weighted_sum(ensemble.shares(scores), weights)
    return combined.select("query_id", "label", r6("score"))


CANDIDATES = ensemble.starting_weights(FIXED)
_CANDIDATE_ROWS = ", ".join(
    f"({i}, '{rep}', CAST({w!r} AS DOUBLE))" for i, c in enumerate(CANDIDATES) for rep, w in c.items()
)


@data.shared
def sharp_scores(spark, sf):
    scores = votes.class_scores(both_neighbours(spark, sf).filter("rank <= 11"), 2.0, None, ["rep"])
    return stage(ensemble.sharpened(ensemble.shares(scores), 1.5), "sharp")


@query(sql.with_(
    *_two(), f"nn AS ({_BOTH})", f"cw(candidate, rep, weight) AS (VALUES {_CANDIDATE_ROWS})",
    "raw AS (SELECT rep, query_id, label, sum(pow(greatest(sim, 0), 2)) AS s FROM nn GROUP BY ALL)",
    "sh AS (SELECT *, s / (CASE WHEN sum(s) OVER w = 0 THEN 1 ELSE sum(s) OVER w END) AS p FROM raw WINDOW w AS (PARTITION BY rep, query_id))",
    "hot AS (SELECT rep, query_id, label, pow(p, 1.5) AS p FROM sh)",
    "fin AS (SELECT *, p / (CASE WHEN sum(p) OVER w = 0 THEN 1 ELSE sum(p) OVER w END) AS share FROM hot WINDOW w AS (PARTITION BY rep, query_id))",
    "sc AS (SELECT candidate, query_id, label, sum(weight * share) AS score FROM fin JOIN cw USING (rep) GROUP BY ALL)",
    "best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY candidate, query_id ORDER BY round(score, 9) DESC, label) = 1)",
    "j AS (SELECT candidate, truth, label AS pred FROM best JOIN xdb ON doc_id = query_id)",
) + f"SELECT CAST(candidate AS INTEGER) AS candidate, round(macro_f1, 6) AS macro_f1 FROM ({sql.macro_f1('j', 'candidate')})")
def e6_weight_candidates(spark, sf):
    scored = ensemble.score_candidates(sharp_scores(spark, sf), turn_truth(spark, sf), CANDIDATES, 1)
    return scored.select("candidate", r6("macro_f1"))


@query()
def e6_weight_search(spark, sf):
    best, f1 = ensemble.search_weights(sharp_scores(spark, sf), turn_truth(spark, sf), FIXED, 1)
    rows = [(name, float(w), float(f1)) for name, w in best.items()]
    return spark.createDataFrame(rows, "rep string, weight double, macro_f1 double")
