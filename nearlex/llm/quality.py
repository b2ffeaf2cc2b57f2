"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes a short vector of transformed statistics.  Class counts,
sums and outer products are added up across partitions; class covariances are
shrunk towards the pooled one and towards a multiple of the identity.  The score
is the logistic of the difference of two log-densities, each a Mahalanobis
distance solved with a Cholesky factor that is computed once per model.

Edge cases: a null or empty text has the statistics of zero words and gets a
score like any other.  A null id is not held out and joins no label.  Labels
other than 0 and 1 are ignored; repeated label rows count once each.  With no
label of one class, every score is the share of label 1 among the learned rows
(0.5 without any).  Extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from nearlex.llm.base import arrow_step, bound_batches, remainder, replaced, texts
from nearlex.session import stage

FEATURES = (
    "words", "word_length", "capitals", "marks", "exclamations", "digits", "stops", "repeats",
    "distinct", "squeezed", "line_words", "same_lines",
)
_KINDS = np.zeros(256, np.uint8)
for _code, _chars in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"#*$%&|<>", b"!",
     b"0123456789", b".,;:?", b" \t\n\x0b\x0c\r"), start=1
):
    _KINDS[list(_chars)] = _code
_KINDS[128:] = 8


def statistics(text: str, squeeze: zstandard.ZstdCompressor) -> list[float]:
    """Transformed statistics of one text.

    Shares go through the arcsine of the root, which keeps rare marks apart and
    is zero for none at any length; a few pseudo-words keep one-word texts near
    the others.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=9)
    letters = kinds[1] + kinds[2]
    lines = [part for part in raw.split(b"\n") if part.strip()]

    def share(part: float, whole: float, prior: float = 20.0) -> float:
        return float(np.arcsin(np.sqrt(min(1.0, part / (whole + prior)))))

    repeats = sum(map(bytes.__eq__, words, words[1:]))
    shrunk = (len(squeeze.compress(raw)) + 200.0) / (len(raw) + 400.0)
    return [
        np.log1p(n),
        np.log((len(raw) - kinds[7] + 110.0) / (n + 20.0)),
        share(kinds[1], letters, 100.0),
        share(kinds[3], 4 * n),
        share(kinds[4], 2 * n),
        share(kinds[5], len(raw), 100.0),
        share(kinds[6], n),
        share(repeats, n),
        np.log((len(set(words)) + 20.0) / (n + 20.0)),
        np.log(shrunk),
        np.log1p(n / (len(lines) + 1.0)),
        share(len(lines) - len(set(lines)), len(lines)),
    ]


def matrix(values: list[str]) -> np.ndarray:
    squeeze = zstandard.ZstdCompressor(level=1)
    rows = [statistics(t, squeeze) for t in values]
    return np.asarray(rows, dtype=np.float64).reshape(len(rows), len(FEATURES))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): one statistics vector per row of ``docs``."""
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(texts(batch))
        offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
        return replaced(batch, "text", x=pa.ListArray.from_arrays(offsets, x.ravel()))

    return arrow_step(docs.select("doc_id", "text"), f"doc_id {kind}, x array<double>", step)


@dataclass
class Model:
    """Class means, Cholesky factors and offsets in standardised units."""

    centre: np.ndarray
    scale: np.ndarray
    prior: float
    means: list[np.ndarray] = field(default_factory=list)
    factors: list[np.ndarray] = field(default_factory=list)
    offsets: list[float] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            solved = np.linalg.solve(factor, (z - mean).T)
            density.append(offset - 0.5 * np.square(solved).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def moments(labelled: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and outer-product sum of each class, combined before the shuffle.

    The result has at most two classes times d * d numbers, whatever the input.
    """
    d = len(FEATURES)
    shape = "label int, n long, position int, total double"

    def partial(batches):
        held = {}
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, d)
            label = np.asarray(batch.column("label"))
            for k in (0, 1):
                rows = x[label == k]
                if len(rows):
                    n, both = held.get(k, (0, np.zeros((d + 1) * d)))
                    held[k] = (n + len(rows), both + np.concatenate([rows.sum(axis=0), (rows.T @ rows).ravel()]))
        for k, (n, both) in held.items():
            size = len(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * size, pa.int32()), pa.array([n] + [0] * (size - 1), pa.int64()),
                 pa.array(range(size), pa.int32()), pa.array(both)],
                names=["label", "n", "position", "total"],
            )

    sums = (
        labelled.mapInArrow(partial, shape)
        .groupBy("label", "position")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .collect()
    )
    out = {}
    for k in {row["label"] for row in sums}:
        mine = sorted((r["position"], r["total"], r["n"]) for r in sums if r["label"] == k)
        flat = np.array([r[1] for r in mine])
        out[k] = (sum(r[2] for r in mine), flat[:d], flat[d:].reshape(d, d))
    return out


def fit(
    features_of_docs: DataFrame, labels: DataFrame, shrink: float = 0.15, ridge: float = 0.05
) -> Model:
    """Learn from labelled rows outside the hold-out.

    ``shrink`` moves each class covariance towards the pooled one, ``ridge``
    moves the result towards its mean variance times the identity.
    """
    d = len(FEATURES)
    marks = (
        labels.filter(F.col("quality").isin(0, 1))
        .select(F.col("doc_id").alias("labelled_id"), F.col("quality").cast("int").alias("label"))
    )
    learned = (
        features_of_docs.filter(remainder(F.col("doc_id"), 3) != 1)
        .join(marks, F.col("doc_id") == F.col("labelled_id"))
        .select("label", "x")
    )
    parts = moments(learned)
    count = {k: parts[k][0] if k in parts else 0 for k in (0, 1)}
    total = count[0] + count[1]
    if not count[0] or not count[1]:
        return Model(np.zeros(d), np.ones(d), count[1] / total if total else 0.5)
    mean = (parts[0][1] + parts[1][1]) / total
    spread = {}
    for k in (0, 1):
        n, first, second = parts[k]
        own = first / n
        spread[k] = second / n - np.outer(own, own)
    pooled = (count[0] * spread[0] + count[1] * spread[1]) / total
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    model = Model(mean, scale, count[1] / total)
    unit = np.outer(scale, scale)
    for k in (0, 1):
        mixed = ((1 - shrink) * spread[k] + shrink * pooled) / unit
        mixed = (1 - ridge) * mixed + ridge * max(np.trace(mixed) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(mixed)
        model.means.append((parts[k][1] / count[k] - mean) / scale)
        model.factors.append(factor)
        model.offsets.append(float(np.log(count[k] / total) - np.log(np.diag(factor)).sum()))
    return model


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    seen = stage(features(docs), "quality")
    model = fit(seen, labels)
    kind = dict(docs.dtypes)["doc_id"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, len(FEATURES))
        return replaced(batch, "x", score=pa.array(model.score(x)))

    scored = arrow_step(seen, f"doc_id {kind}, score double", step)
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    model = fit(stage(features(docs), "quality"), labels)

    @pandas_udf("double")
    def score(text):
        return text.__class__(model.score(matrix([t or "" for t in text])), index=text.index)

    return docs.filter(score(F.col("text")) >= threshold)
