"""Neighbours to class scores and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scores are compared after rounding to this many digits, so sums taken in
#: another order decide alike.
SCORE_DIGITS = 9


def similarity_weight(power: float = 1.0, clamp: bool | None = None) -> Column:
    """Vote weight of ``sim``; negatives count as zero if ``clamp``.

    ``clamp=None`` clamps only when a power is applied.
    """
    sim = F.col("sim")
    if clamp or (clamp is None and power != 1.0):
        sim = F.greatest(sim, F.lit(0.0))
    return sim if power == 1.0 else F.pow(sim, F.lit(float(power)))


def distance_weight(power: float = 1.0) -> Column:
    """Inverse distance, raised to ``power``."""
    w = F.lit(1.0) / (F.sqrt(F.greatest("dist2", F.lit(0.0))) + F.lit(1e-9))
    return w if power == 1.0 else F.pow(w, F.lit(float(power)))


def vote_weight(neighbours: DataFrame, power: float, clamp: bool | None) -> Column:
    if "dist2" in neighbours.columns:
        return distance_weight(power)
    return similarity_weight(power, clamp)


def class_scores(
    neighbours: DataFrame, power: float = 2.0, clamp: bool | None = True, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of vote weights per class; classes without a neighbour have no row."""
    return neighbours.groupBy(*by, "query_id", "label").agg(
        F.sum(vote_weight(neighbours, power, clamp)).alias("score")
    )


def class_counts(neighbours: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Neighbours per class, the scores of a majority vote."""
    return neighbours.groupBy(*by, "query_id", "label").agg(
        F.count(F.lit(1)).cast("double").alias("score")
    )


def nearest_first_scores(neighbours: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weighted scores that remember the best rank of each class for ties."""
    return neighbours.groupBy(*by, "query_id", "label").agg(
        F.sum("sim").alias("score"), F.min("rank").alias("first_rank")
    )


def decide(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Best class per query; ties to the nearest class if known, else the lowest label."""
    tie = -F.col("first_rank") if "first_rank" in scores.columns else -F.col("label")
    merit = F.struct(F.round("score", SCORE_DIGITS), tie)
    return scores.groupBy(*by, "query_id").agg(F.max_by("label", merit).alias("pred"))


def for_all_queries(
    decided: DataFrame, queries: DataFrame, lowest_label: int, query_key: str = "doc_id"
) -> DataFrame:
    """Keep queries without any neighbour; all their scores are zero: lowest label."""
    ids = queries.select(F.col(query_key).alias("query_id"))
    return ids.join(decided, "query_id", "left").withColumn(
        "pred", F.coalesce("pred", F.lit(lowest_label)).cast("int")
    )


def with_all_classes(
    scores: DataFrame, queries: DataFrame, labels: Sequence[int], query_key: str = "doc_id"
) -> DataFrame:
    """One row per query and class, zero where a class has no neighbour."""
    classes = F.explode(F.array(*[F.lit(int(c)) for c in sorted(labels)]))
    grid = queries.select(F.col(query_key).alias("query_id"), classes.alias("label"))
    return grid.join(scores, ["query_id", "label"], "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )
