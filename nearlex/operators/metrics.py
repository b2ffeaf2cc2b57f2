"""Confusion counts and macro-averaged F1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (truth, pred)."""
    return judged.groupBy(*by, "truth", "pred").agg(F.count(F.lit(1)).alias("n"))


def class_f1(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1 per class over the union of true and predicted classes; 0/0 is 0."""
    hit = F.col("truth") == F.col("pred")
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("truth").alias("label"),
            F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
            F.when(hit, zero).otherwise(F.col("n")).alias("miss"),
        ),
        F.struct(
            F.col("pred").alias("label"),
            zero.alias("tp"),
            F.when(hit, zero).otherwise(F.col("n")).alias("miss"),
        ),
    )
    flat = confusion(judged, by).select(*by, F.explode(sides).alias("s"))
    counts = flat.groupBy(*by, F.col("s.label").alias("label")).agg(
        F.sum("s.tp").alias("tp"), F.sum("s.miss").alias("miss")
    )
    doubled = F.col("tp") * 2.0
    return counts.select(
        *by, "label",
        F.when(doubled + F.col("miss") > 0, doubled / (doubled + F.col("miss")))
        .otherwise(F.lit(0.0)).alias("f1"),
    )


def macro_f1(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of the per-class F1 of ``truth`` against ``pred``."""
    return class_f1(judged, by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def first_best(scored: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Highest F1 per group; the smallest (numeric) setting in ``order`` wins ties."""
    merit = F.struct(F.round("macro_f1", 9), *[-F.col(c) for c in order])
    best = F.max_by(F.struct(*order, "macro_f1"), merit).alias("b")
    return scored.groupBy(*by).agg(best).select(*by, "b.*")
