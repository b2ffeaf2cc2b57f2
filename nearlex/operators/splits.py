"""Reproducible train and validation splits, ordered by a hash of the id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearlex.operators.ranking import before_rank, head, ranked
from nearlex.session import stage


def shuffle_key(id_col: str, seed: int) -> Column:
    """Seeded pseudo-random sort key of a row, the same on every engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


#: Fit rows of so many rows in a quick search.
FIT_PARTS = (10_000, 12_000)


def class_quotas(counts: dict[int, int], val_size: float) -> dict[int, int]:
    """Validation rows per class: largest remainders, ties to the lower label."""
    n = sum(counts.values())
    n_fit = n - math.ceil(val_size * n)
    exact = {c: counts[c] * n_fit / n for c in counts}
    fit = {c: math.floor(x) for c, x in exact.items()}
    spare = n_fit - sum(fit.values())
    for c in sorted(counts, key=lambda c: (-round(exact[c] - fit[c], 9), *_null_first(c)))[:spare]:
        fit[c] += 1
    return {c: counts[c] - fit[c] for c in counts}


def _null_first(label: int | None) -> tuple:
    """Sort key of a class; rows without a label are a class of their own."""
    return (label is not None, label or 0)


def stratified_holdout(
    docs: DataFrame, val_size: float = 0.1, seed: int = 42,
    id_col: str = "doc_id", label_col: str = "label",
) -> DataFrame:
    """``id, label, is_val`` with every class keeping its share.

    One global sort by (label, key) serves all classes; a window per class
    would put a dominant class into one task.
    """
    rows = docs.select(id_col, label_col)
    counts = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}
    quotas = class_quotas(counts, val_size) if counts else {}
    ordered = rows.withColumn("_key", shuffle_key(id_col, seed))
    order = [F.asc_nulls_first(label_col), F.col("_key"), F.col(id_col)]
    is_val, start = F.lit(False), 0
    for label in sorted(counts, key=_null_first):
        inside = (F.col("_rank") >= start) & (F.col("_rank") < start + quotas[label])
        is_val = is_val | inside
        start += counts[label]
    return ranked(ordered, order, "_rank").select(id_col, label_col, is_val.alias("is_val"))


def random_split(
    docs: DataFrame, fit_share: float = 0.8, seed: int = 42, id_col: str = "doc_id",
    fit_rows: int | None = None,
) -> DataFrame:
    """Input rows with ``is_val``: shuffled, the first ``fit_share`` (or rows) fit."""
    n = docs.count()
    fit = int(fit_share * n) if fit_rows is None else fit_rows
    order = [shuffle_key(id_col, seed), F.col(id_col)]
    return docs.withColumn("is_val", ~before_rank(docs, order, fit))


def quick_search_split(
    docs: DataFrame, rows: int | None = None, fit_rows: int | None = None, seed: int = 42,
    id_col: str = "doc_id",
) -> DataFrame:
    """Documents shuffled into five parts to fit and one to validate.

    ``rows`` takes the first rows only and ``fit_rows`` bounds the fit part;
    every other row is validated.  By default all rows are used.
    """
    subset = docs if rows is None else head(docs, rows, id_col)
    n = subset.count()
    share = n * FIT_PARTS[0] // FIT_PARTS[1]
    fit = share if fit_rows is None else min(fit_rows, share)
    return random_split(subset, seed=seed, id_col=id_col, fit_rows=fit)


def parts(vectors: DataFrame, split: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Fit and validation rows of a vector table."""
    marked = stage(vectors.join(split.select(id_col, "is_val"), id_col), "split")
    return (
        marked.filter(~F.col("is_val")).drop("is_val"),
        marked.filter(F.col("is_val")).drop("is_val"),
    )
