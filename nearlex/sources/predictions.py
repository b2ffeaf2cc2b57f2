"""Prediction sinks and corpus checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_keyed(predictions: DataFrame, path: str) -> None:
    """``doc_id, pred`` as parquet: the form to use at scale."""
    predictions.select("doc_id", "pred").write.parquet(path)


def write_lines(predictions: DataFrame, path: str) -> None:
    """One label per line in ``doc_id`` order.

    The parts are range-partitioned and sorted, so their names in order give
    the file; nothing is gathered into one task.
    """
    (
        predictions.orderBy("doc_id")
        .select(F.col("pred").cast("string").alias("value"))
        .write.text(path)
    )


def reconcile(predictions: DataFrame, expected: DataFrame, key: str = "doc_id") -> DataFrame:
    """Row counts on both sides and ids found on one side only."""
    p = predictions.select(key).distinct().withColumn("_p", F.lit(1))
    e = expected.select(key).distinct().withColumn("_e", F.lit(1))
    one = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))
    return p.join(e, key, "full_outer").agg(
        one(F.col("_p").isNotNull()).alias("n_predicted"),
        one(F.col("_e").isNotNull()).alias("n_expected"),
        one(F.col("_e").isNull()).alias("unexpected"),
        one(F.col("_p").isNull()).alias("missing"),
    )


def label_histogram(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label; also the sorted distinct labels and, summed, the row count."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
