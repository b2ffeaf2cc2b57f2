import numpy as np
import pytest
from pyspark.sql import functions as F

from nearlex.operators import ensemble, metrics, splits, sweeps, votes


def judged(spark, pairs, by=None):
    rows = [(by, t, p) for t, p in pairs]
    return spark.createDataFrame(rows, "k int, truth int, pred int")


def test_macro_f1_is_unweighted_over_the_union_of_classes(spark):
    pairs = [(1, 1), (1, 1), (1, 2), (2, 2), (3, 4)]
    got = metrics.macro_f1(judged(spark, pairs, 1)).first()[0]
    assert got == pytest.approx((0.8 + 2 / 3 + 0 + 0) / 4)


def test_confusion_counts(spark):
    rows = metrics.confusion(judged(spark, [(1, 1), (1, 2), (1, 2)])).collect()
    assert {(r["truth"], r["pred"]): r["n"] for r in rows} == {(1, 1): 1, (1, 2): 2}


def test_first_best_keeps_the_earliest(spark):
    scored = spark.createDataFrame([("a", 3, 0.5), ("a", 1, 0.5), ("a", 5, 0.4), ("b", 9, 0.1)], "rep string, k int, macro_f1 double")
    rows = metrics.first_best(scored, ["k"], ["rep"]).collect()
    assert {r["rep"]: r["k"] for r in rows} == {"a": 1, "b": 9}


def test_quotas_keep_shares_and_sum_up():
    assert splits.class_quotas({1: 620, 2: 129, 3: 145, 4: 106}, 0.1) == {1: 62, 2: 13, 3: 14, 4: 11}
    assert sum(splits.class_quotas({1: 3, 2: 3, 3: 3}, 0.1).values()) == 1


def test_stratified_holdout_is_exact_and_stable(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 700, 1).otherwise(2).alias("label"))
    one = splits.stratified_holdout(docs)
    sizes = {r["label"]: r["n"] for r in one.filter("is_val").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sizes == {1: 70, 2: 30}
    again = splits.stratified_holdout(docs.repartition(5))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, again.collect()))


def test_random_and_quick_splits(spark):
    docs = spark.range(101).select(F.col("id").alias("doc_id"))
    assert splits.random_split(docs).filter("is_val").count() == 21
    quick = splits.quick_search_split(docs, rows=60, fit_rows=50)
    assert quick.count() == 60 and quick.filter("is_val").count() == 10
    assert quick.agg(F.max("doc_id")).first()[0] == 59


SCORES = [
    ("a", 1, 1, 3.0), ("a", 1, 2, 1.0), ("b", 1, 2, 5.0), ("a", 2, 1, 0.0), ("b", 2, 2, 1.0),
]


def scores(spark):
    return spark.createDataFrame(SCORES, "rep string, query_id bigint, label int, score double")


def test_weighted_sum_defaults_to_one(spark):
    rows = ensemble.weighted_sum(scores(spark), {"b": 0.1}).collect()
    got = {(r["query_id"], r["label"]): round(r["score"], 6) for r in rows}
    assert got == {(1, 1): 3.0, (1, 2): 1.5, (2, 1): 0.0, (2, 2): 0.1}


def test_shares_and_temperature(spark):
    rows = ensemble.sharpened(ensemble.shares(scores(spark)), 2.0).collect()
    got = {(r["rep"], r["query_id"], r["label"]): round(r["score"], 6) for r in rows}
    assert got == {("a", 1, 1): 0.9, ("a", 1, 2): 0.1, ("b", 1, 2): 1.0, ("a", 2, 1): 0.0, ("b", 2, 2): 1.0}


def test_weight_search_beats_the_base(spark):
    truth = spark.createDataFrame([(1, 1), (2, 2)], "query_id bigint, truth int")
    sharp = ensemble.shares(scores(spark))
    start = ensemble.score_candidates(sharp, truth, [{"a": 0.3, "b": 0.7}], 1).first()["macro_f1"]
    best, f1 = ensemble.search_weights(sharp, truth, {"a": 0.3, "b": 0.7}, 1)
    assert f1 == 1.0 > start and sum(best.values()) == pytest.approx(1.0)


def test_k_sweep_at_one_k_equals_a_direct_run(spark):
    rows = [(1, 10, 1, 0.9, 1), (1, 11, 2, 0.6, 2), (1, 12, 2, 0.5, 3), (2, 11, 2, 0.4, 1)]
    found = spark.createDataFrame(rows, "query_id bigint, train_id bigint, label int, sim double, rank int")
    truth = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "query_id bigint, truth int")
    swept = {r["k"]: r["macro_f1"] for r in sweeps.k_sweep(found, truth, (1, 3), 1).collect()}
    assert swept[1] == 1.0
    assert swept[3] == sweeps.k_sweep(found, truth, (3,), 1).first()["macro_f1"] == pytest.approx(2 / 3)


def test_weight_search_is_no_worse_than_any_start(spark):
    from nearlex.operators import ensemble

    rows = [("a", q, label, 0.9 if (q % 3 == label - 1) else 0.1) for q in range(12) for label in (1, 2, 3)]
    rows += [("b", q, label, 0.8 if (q % 2 == label - 1) else 0.2) for q in range(12) for label in (1, 2, 3)]
    sharp = spark.createDataFrame(rows, "rep string, query_id bigint, label int, score double")
    truth = spark.createDataFrame([(q, q % 3 + 1) for q in range(12)], "query_id bigint, truth int")
    base = {"a": 0.1, "b": 1.0}
    best, f1 = ensemble.search_weights(sharp, truth, base, 1)
    starts = ensemble.starting_weights(base)
    scored = ensemble.score_candidates(sharp, truth, [best, *starts], 1).collect()
    by = {r["candidate"]: r["macro_f1"] for r in scored}
    assert by[0] == pytest.approx(f1) and all(f1 >= v - 1e-9 for v in by.values())


def test_holdout_with_rows_without_a_label(spark):
    docs = spark.createDataFrame([(i, i % 3 or None) for i in range(30)], "doc_id bigint, label int")
    split = splits.stratified_holdout(docs, 0.2)
    assert split.count() == 30 and split.filter("is_val").count() == 6


def test_sweep_shuffles_neighbours_once_whatever_the_list(spark):
    rng = np.random.default_rng(3)
    rows = [(q, 100 + r, int(rng.integers(1, 4)), round(float(rng.random()), 2), r) for q in range(30) for r in range(1, int(rng.integers(2, 40)))]
    found = spark.createDataFrame(rows, "query_id bigint, train_id bigint, label int, sim double, rank int")
    truth = spark.createDataFrame([(q, q % 3 + 1) for q in range(32)], "query_id bigint, truth int")
    ks = (1, 2, 5, 9, 30, 50)
    swept = {r["k"]: r["macro_f1"] for r in sweeps.k_sweep(found, truth, ks, 1).collect()}
    for k in ks:
        decided = votes.decide(votes.nearest_first_scores(found.filter(F.col("rank") <= k)))
        assert swept[k] == pytest.approx(metrics.macro_f1(sweeps.judged(decided, truth, 1)).first()["macro_f1"])
    for several in ((5,), tuple(range(1, 60))):
        plan = sweeps.winners(found, several)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
