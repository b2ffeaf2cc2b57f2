"""All pairs of sparse vectors whose product reaches a threshold, without forming the others.

Terms have one order in all vectors, rarest first (vocabularies number frequent
terms first, so larger ids are rarer; any order gives the same pairs).  If a
pair's first common term is ``c``, its product is at most the product of what is
left of both norms from ``c`` on.  So an entry needs indexing only while the rest
of its vector can still reach the threshold, and two entries of a term meet only
if their rests together can.  What meets is verified on the whole vectors.

Empty vectors and empty tables have no pairs.  Missing and repeated ids are
refused, as in ``neighbours.nearest``.  Weights may be negative.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearlex.operators.kernels import _lists
from nearlex.operators.neighbours import ROWS_PER_SALT, check_ids, squared_norms
from nearlex.session import bound_batches, broadcast_if_small, stage

#: Classes of the rest of a vector; an entry of a query is repeated at most once per class.
BANDS = 16

#: Allowance for sums taken in another order.
SLACK = 1e-9


def _norm(vectors: DataFrame) -> float:
    found = vectors.agg(F.max(squared_norms(vectors))).first()[0]
    return math.sqrt(found or 0.0)


def prefixes(vectors: DataFrame, least: float, id_col: str) -> DataFrame:
    """``id_col, term_id, w, rest, after``: entries at which the rest of the vector has the norm ``least``.

    ``rest`` counts the entry itself, ``after`` only what follows it.
    """
    kind = vectors.schema["vec"].dataType.elementType["term_id"].dataType.simpleString()
    bound_batches(vectors.sparkSession)

    def cut(batches):
        for batch in batches:
            sizes, flat = _lists(pa.Table.from_batches([batch]))
            terms = flat.field(0).to_numpy(zero_copy_only=False)
            weights = flat.field(1).to_numpy(zero_copy_only=False).astype(np.float64)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((terms, rows))
            summed = np.concatenate([[0.0], np.cumsum(weights[order] ** 2)])
            starts = np.cumsum(sizes) - sizes
            first = summed[starts[rows[order]]]
            rest, after = (np.sqrt(np.maximum(x - first, 0.0)) + SLACK for x in (summed[1:], summed[:-1]))
            kept = rest >= least
            chosen = order[kept]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows[chosen])), pa.array(terms[chosen]), pa.array(weights[chosen]),
                    pa.array(rest[kept]), pa.array(after[kept]),
                ],
                names=[id_col, "term_id", "w", "rest", "after"],
            )

    rows = vectors.select("doc_id", "vec").filter(F.size("vec") > 0)
    id_kind = vectors.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"{id_col} {id_kind}, term_id {kind}, w double, rest double, after double")


def candidates(queries: DataFrame, train: DataFrame, threshold: float) -> DataFrame:
    """``query_id, train_id`` of every pair that may reach ``threshold``, each once.

    Entries meet on term and class of the rest, so a frequent term joins only
    rests that are large enough together; a term and class with very many
    meetings is dealt over parts on both sides.
    """
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    q_norm, t_norm = _norm(queries), _norm(train)
    q = stage(prefixes(queries, threshold / (t_norm or 1.0), "query_id"), "query-prefixes")
    t = stage(prefixes(train, threshold / (q_norm or 1.0), "train_id"), "train-prefixes")

    def band(norm: float):
        return F.least(F.ceil(F.col("rest") / F.lit((norm or 1.0) + SLACK) * BANDS), F.lit(BANDS)).cast("int")

    # The lowest class of documents that a query's rest can reach the threshold with.
    lowest = F.greatest(
        F.floor(F.lit(threshold * BANDS) / (F.col("rest") * F.lit((t_norm or 1.0) + SLACK))), F.lit(1)
    ).cast("int")
    q = q.withColumn("band", F.explode(F.sequence(F.least(lowest, F.lit(BANDS)), F.lit(BANDS))))
    t = t.withColumn("band", band(t_norm))
    keys = ["term_id", "band"]
    heavy = (
        q.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_q"))
        .join(t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_t")), keys)
        .filter(F.col("n_q") * F.col("n_t") > ROWS_PER_SALT**2)
        .select(*keys, *[F.ceil(F.col(n) / ROWS_PER_SALT).cast("int").alias(p) for n, p in (("n_q", "q_parts"), ("n_t", "t_parts"))])
    )
    parts = broadcast_if_small(stage(heavy, "heavy-terms"))

    def dealt(rows: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
        many = {p: F.coalesce(f"{p}_parts", F.lit(1)) for p in (own, other)}
        return rows.join(parts, keys, "left").select(
            id_col, *keys, *[F.col(c).alias(f"{own}_{c}") for c in ("w", "rest", "after")],
            F.pmod(F.xxhash64(id_col), many[own]).cast("int").alias(f"{own}_part"),
            F.explode(F.sequence(F.lit(0), many[other] - 1)).alias(f"{other}_part"),
        )

    left, right = dealt(q, "query_id", "q", "t"), dealt(t, "train_id", "t", "q")
    both = [*keys, "q_part", "t_part"]
    met = left.join(right, both).filter(F.col("q_rest") * F.col("t_rest") >= F.lit(threshold - SLACK))
    bound = F.sum(F.col("q_w") * F.col("t_w")) + F.min(F.col("q_after") * F.col("t_after"))
    pairs = met.groupBy("query_id", "train_id").agg(bound.alias("bound"))
    return pairs.filter(F.col("bound") >= F.lit(threshold - SLACK)).select("query_id", "train_id")


def _verified(batches):
    for batch in batches:
        q_sizes, q = _lists(pa.table({"vec": batch.column(2)}))
        t_sizes, t = _lists(pa.table({"vec": batch.column(3)}))
        row = np.repeat(np.arange(batch.num_rows), q_sizes), np.repeat(np.arange(batch.num_rows), t_sizes)
        terms = q.field(0).to_numpy(zero_copy_only=False), t.field(0).to_numpy(zero_copy_only=False)
        names, numbered = np.unique(np.concatenate(terms), return_inverse=True)
        keys = [r * len(names) + n for r, n in zip(row, np.split(numbered, [len(terms[0])]))]
        order = np.argsort(keys[0], kind="stable")
        at = np.searchsorted(keys[0][order], keys[1])
        shared = np.flatnonzero(at < len(order))
        shared = shared[keys[0][order[at[shared]]] == keys[1][shared]]
        product = (
            q.field(1).to_numpy(zero_copy_only=False)[order[at[shared]]] * t.field(1).to_numpy(zero_copy_only=False)[shared]
        )
        dot = np.bincount(row[1][shared], weights=product, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dot)], names=["query_id", "train_id", "dot"])


def similar(queries: DataFrame, train: DataFrame, threshold: float) -> DataFrame:
    """``query_id, train_id, dot`` of all pairs with ``dot >= threshold``.

    The result is whole: candidates are only left out where their bound shows
    that they stay below.
    """
    check_ids("queries", queries)
    check_ids("documents", train)
    met = candidates(queries, train, threshold)
    whole = (
        met.join(queries.select(F.col("doc_id").alias("query_id"), F.col("vec").alias("q")), "query_id")
        .join(train.select(F.col("doc_id").alias("train_id"), F.col("vec").alias("t")), "train_id")
        .select("query_id", "train_id", "q", "t")
    )
    kinds = [f"{c} {met.schema[c].dataType.simpleString()}" for c in ("query_id", "train_id")]
    return whole.mapInArrow(_verified, f"{kinds[0]}, {kinds[1]}, dot double").filter(F.col("dot") >= F.lit(threshold))
