"""Parameter sweeps: neighbours are found once, settings are explored on scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearlex.operators import ensemble, neighbours as nb, votes
from nearlex.operators.metrics import first_best, macro_f1
from nearlex.operators.vectors import bm25_weight, weigh_variants
from nearlex.session import stage

# The settings swept by default.
K_SPARSE = (1, 3, 5, 7, 9, 11, *range(21, 42))
K_DENSE = (3, 5, 7, 9, 11, 21, 31, 41, 51, 71, 101, 151, 201, 301)
K1_GRID = (1.2, 1.5, 2.0)
B_GRID = (0.5, 0.75, 1.0)
POWER_GRID = (1.0, 2.0, 3.0, 5.0)
TEMPERATURE_GRID = (1.0, 1.5, 2.0, 3.0)


def judged(
    decided: DataFrame, truth: DataFrame, lowest_label: int, by: Sequence[str] = (), settings=None
) -> DataFrame:
    """Predictions beside the truth; a query without a score gets the lowest label."""
    wanted = truth if settings is None else truth.select("*", settings)
    return wanted.join(decided, [*by, "query_id"], "left").withColumn(
        "pred", F.coalesce("pred", F.lit(lowest_label))
    )


def winners(found: DataFrame, ks: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """``query_id, preds``: the winning label of each query for every k that has a neighbour, as a map.

    A class' score changes only at its own neighbours, so each neighbour stands
    for the ks up to the next one of its class, with the running sum there.  The
    neighbours are shuffled once, by query; nothing is copied before that.
    """
    keys = [*by, "query_id"]
    rows = found.filter(F.col("rank") <= max(ks)).select(*keys, "label", "rank", "sim").repartition(*keys)
    own = Window.partitionBy(*keys, "label").orderBy("rank")
    running = rows.select(
        *keys, "label", "rank", F.sum("sim").over(own).alias("score"), F.min("rank").over(own).alias("first_rank"),
        F.lead("rank").over(own).alias("_next"),
    )
    listed = F.array(*[F.lit(int(k)) for k in ks])
    standing = F.filter(listed, lambda k: (k >= F.col("rank")) & (F.col("_next").isNull() | (k < F.col("_next"))))
    decided = votes.decide(running.withColumn("k", F.explode(standing)), [*by, "k"])
    return decided.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "pred"))).alias("preds"))


def k_sweep(
    found: DataFrame, truth: DataFrame, ks: Sequence[int], lowest_label: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """Macro-F1 for every k from one top-max(k) neighbour table.

    Votes are similarity-weighted, ties to the class with the nearest member; a
    query without a neighbour gets the lowest label.
    """
    listed = F.array(*[F.lit(int(k)) for k in ks])
    both = truth.join(winners(found, ks, by), [*by, "query_id"], "left")
    each = both.select(*by, "query_id", "truth", "preds", F.explode(listed).alias("k"))
    pred = F.coalesce(F.try_element_at("preds", F.col("k")), F.lit(lowest_label))
    return macro_f1(each.withColumn("pred", pred), [*by, "k"])


def bm25_grid(
    bag: DataFrame, vocab: DataFrame, split: DataFrame, avgdl: float, lowest_label: int,
    k: int = 11, k1s: Sequence[float] = K1_GRID, bs: Sequence[float] = B_GRID,
) -> DataFrame:
    """Macro-F1 per (k1, b), all settings in one neighbour job keyed by ``rep``."""
    both = bag.join(split.select("doc_id", "is_val"), "doc_id")
    every = weigh_variants(
        both, vocab, {f"{k1}|{b}": bm25_weight(avgdl, k1, b) for k1 in k1s for b in bs}
    )
    fit = every.filter(~F.col("is_val")).drop("is_val")
    val = every.filter(F.col("is_val")).drop("is_val", "label")
    truth = split.filter("is_val").select(
        F.col("doc_id").alias("query_id"), F.col("label").alias("truth")
    )
    found = nb.nearest(val, fit, k, fill=False, by=["rep"])
    decided = votes.decide(votes.nearest_first_scores(found, ["rep"]), ["rep"])
    reps = F.explode(F.array(*[F.lit(f"{k1}|{b}") for k1 in k1s for b in bs])).alias("rep")
    scored = macro_f1(judged(decided, truth, lowest_label, ["rep"], reps), ["rep"])
    setting = F.split("rep", "\\|")
    return scored.select(
        setting[0].cast("double").alias("k1"), setting[1].cast("double").alias("b"), "macro_f1"
    )


def power_temperature_grid(
    found: DataFrame, truth: DataFrame, weights: Mapping[str, float], lowest_label: int,
    powers: Sequence[float] = POWER_GRID, temperatures: Sequence[float] = TEMPERATURE_GRID,
) -> DataFrame:
    """Macro-F1 per (power, temperature) of the weighted ensemble.

    ``found`` holds each representation's neighbours (``rep`` column), already
    cut to that representation's k.
    """
    power = F.explode(F.array(*[F.lit(float(p)) for p in powers])).alias("power")
    rows = found.select("rep", "query_id", "label", "sim", power)
    weight = F.when(F.col("power") == 1.0, F.col("sim")).otherwise(
        F.pow(F.greatest("sim", F.lit(0.0)), F.col("power"))
    )
    raw = rows.groupBy("power", "rep", "query_id", "label").agg(F.sum(weight).alias("score"))
    temperature = F.explode(F.array(*[F.lit(float(t)) for t in temperatures]))
    hot = ensemble.shares(raw, ["power"]).withColumn("temperature", temperature)
    keys = ["power", "temperature"]
    sharp = ensemble.sharpened(hot, F.col("temperature"), keys)
    decided = votes.decide(ensemble.weighted_sum(sharp, weights, keys), keys)
    wanted = truth.select("*", power).select(
        "*", temperature.alias("temperature")
    )
    return macro_f1(judged(decided, wanted, lowest_label, keys), keys)


def best_setting(scored: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return first_best(scored, order, by)


def score_table(
    found: DataFrame, power: float, by: Sequence[str] = ("rep",)
) -> DataFrame:
    """Class scores per representation at one power, staged for reuse."""
    return stage(votes.class_scores(found, power, None, list(by)), "scores")
