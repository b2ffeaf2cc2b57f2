"""Combining class scores of several representations.

Score tables are long: ``rep, query_id, label, score``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearlex.operators.metrics import macro_f1
from nearlex.operators.votes import decide


def weight_of(weights: Mapping[str, float] | None, rep: Column | None = None) -> Column:
    """Weight of the row's representation; unnamed ones count 1."""
    rep = F.col("rep") if rep is None else rep
    out = F.lit(1.0)
    for name, w in (weights or {}).items():
        out = F.when(rep == name, F.lit(float(w))).otherwise(out)
    return out


def weighted_sum(
    scores: DataFrame, weights: Mapping[str, float] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Weighted soft vote over representations."""
    return scores.groupBy(*by, "query_id", "label").agg(
        F.sum(F.col("score") * weight_of(weights)).alias("score")
    )


def shares(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """L1-normalise each query's scores inside each representation."""
    total = F.sum("score").over(Window.partitionBy(*by, "rep", "query_id"))
    return scores.withColumn(
        "score", F.col("score") / F.when(total == 0, F.lit(1.0)).otherwise(total)
    )


def sharpened(scores: DataFrame, temperature: float | Column, by: Sequence[str] = ()) -> DataFrame:
    """Raise shares to ``temperature`` and normalise again."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    powered = scores.withColumn("score", F.pow(F.greatest("score", F.lit(0.0)), t))
    return shares(powered, by)


def tempered_vote(
    scores: DataFrame, weights: Mapping[str, float] | None, temperature: float
) -> DataFrame:
    """Weighted sum of sharpened shares."""
    return weighted_sum(sharpened(shares(scores), temperature), weights)


def starting_weights(base: Mapping[str, float], draws: int = 9, seed: int = 42) -> list[dict]:
    """The normalised base weights and ``draws`` flat Dirichlet samples."""
    names = list(base)
    total = sum(base.values()) or 1.0
    rng = np.random.default_rng(seed)
    rows = [{n: base[n] / total for n in names}]
    rows += [dict(zip(names, map(float, rng.dirichlet(np.ones(len(names)))))) for _ in range(draws)]
    return rows


def score_candidates(
    sharp: DataFrame, truth: DataFrame, candidates: Sequence[Mapping[str, float]], lowest_label: int
) -> DataFrame:
    """Macro-F1 of every candidate weighting in one grouped job.

    ``truth`` has ``query_id, truth``.  The candidates are a constant of the
    plan, so each score row is expanded once per candidate and combined again
    before any shuffle.
    """
    options = F.array(
        *[
            F.struct(F.lit(i).alias("candidate"), weight_of(c, F.col("rep")).alias("weight"))
            for i, c in enumerate(candidates)
        ]
    )
    spread = sharp.select("query_id", "label", "score", F.explode(options).alias("o"))
    combined = spread.groupBy(F.col("o.candidate").alias("candidate"), "query_id", "label").agg(
        F.sum(F.col("score") * F.col("o.weight")).alias("score")
    )
    decided = decide(combined, ["candidate"])
    wanted = truth.select(
        "query_id", "truth",
        F.explode(F.sequence(F.lit(0), F.lit(len(candidates) - 1))).alias("candidate"),
    )
    judged = wanted.join(decided, ["candidate", "query_id"], "left").withColumn(
        "pred", F.coalesce("pred", F.lit(lowest_label))
    )
    return macro_f1(judged, by=["candidate"])


def search_weights(
    sharp: DataFrame, truth: DataFrame, base: Mapping[str, float], lowest_label: int,
    baseline_f1: float = 0.0, rounds: int = 2, seed: int = 42,
) -> tuple[dict[str, float], float]:
    """Best weighting found by refining every start ``rounds`` times.

    Each round multiplies single weights of each start's best up and down and
    scores all moves of all starts in one job.  Ties go to the earlier start and
    move.  Returned weights beat ``baseline_f1`` or are the normalised base.
    """
    starts = starting_weights(base, seed=seed)
    held: list[tuple[dict[str, float], float]] = [(dict(w), -1.0) for w in starts]
    for turn in range(rounds + 1):
        owners, candidates = [], []
        step = 2.0 / max(turn, 1)
        for owner, (weights, _) in enumerate(held):
            moves = [dict(weights)]
            for name in weights if turn else ():
                for factor in (step + 1.0, 1.0 / (step + 1.0)):
                    moved = {**weights, name: weights[name] * factor}
                    total = sum(moved.values()) or 1.0
                    moves.append({n: w / total for n, w in moved.items()})
            owners += [owner] * len(moves)
            candidates += moves
        scored = {r["candidate"]: float(r["macro_f1"]) for r in score_candidates(sharp, truth, candidates, lowest_label).collect()}
        improved = False
        for i, owner in enumerate(owners):
            if scored.get(i, -1.0) > held[owner][1] + 1e-9:
                held[owner] = (candidates[i], scored[i])
                improved = True
        if not improved:
            break
    best, best_f1 = dict(starts[0]), baseline_f1
    for weights, f1 in held:
        if f1 > best_f1 + 1e-9:
            best, best_f1 = dict(weights), f1
    return best, best_f1
