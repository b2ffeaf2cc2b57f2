"""Weighting formulas as column expressions; weights take arrays of numbers as well."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def idf_bm25(df: Column, n_docs: int | Column) -> Column:
    n = n_docs if isinstance(n_docs, Column) else F.lit(float(n_docs))
    return F.log((n - df + F.lit(0.5)) / (df + F.lit(0.5)) + F.lit(1.0))


def idf_smooth(df: Column, n_docs: int | Column) -> Column:
    n = n_docs if isinstance(n_docs, Column) else F.lit(float(n_docs))
    return F.log((n + F.lit(1.0)) / (df + F.lit(1.0))) + F.lit(1.0)


def _log(value):
    return F.log(value) if isinstance(value, Column) else np.log(value)


def bm25(tf: Column, dl: Column, idf: Column, avgdl: float, k1: float = 1.2, b: float = 0.5) -> Column:
    """BM25 weight; a zero average length only occurs when every document is empty."""
    ratio = dl / (float(avgdl) or 1.0)
    return idf * tf * (k1 + 1.0) / (tf + k1 * ((1.0 - b) + b * ratio))


def sublinear(tf: Column, dl: Column, idf: Column) -> Column:
    return (1.0 + _log(tf)) / dl * idf


def tfidf(tf: Column, idf: Column, log_tf: bool = False) -> Column:
    return ((1.0 + _log(tf)) if log_tf else 1.0 * tf) * idf


def unit_vector(vec: Column) -> Column:
    """L2-normalise ``array<struct<term_id, w>>``; an all-zero row stays as it is."""
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, e: acc + e["w"] * e["w"]))
    return F.transform(
        F.transform(F.array(norm), lambda x: F.when(x == 0, F.lit(1.0)).otherwise(x)),
        lambda d: F.transform(
            vec, lambda e: F.struct(e["term_id"].alias("term_id"), (e["w"] / d).alias("w"))
        ),
    )[0]


def unit_dense(vec: Column) -> Column:
    """L2-normalise ``array<double>``; a zero row stays zero."""
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(
        F.transform(F.array(norm), lambda x: F.when(x == 0, F.lit(1.0)).otherwise(x)),
        lambda d: F.transform(vec, lambda x: x / d),
    )[0]
