"""Chi-squared feature selection on real-valued weights."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearlex.operators.ranking import largest, ranked
from nearlex.operators.rowjoin import in_blocks
from nearlex.operators.vectors import entries
from nearlex.functions.expressions import unit_vector
from nearlex.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, collected_if_small, stage


def chi2_scores(train: DataFrame, label_col: str = "label") -> DataFrame:
    """``term_id, chi2`` for labelled vectors.

    With observed class sums o_c, total W and class shares p_c, the statistic
    sum((o_c - p_c W)^2 / (p_c W)) equals sum(o_c^2 / p_c) / W - W, so classes
    without a posting need no row and no terms-by-classes product is built.
    """
    n_docs = train.count()
    shares = train.groupBy(label_col).agg(
        (F.count(F.lit(1)) / F.lit(float(max(n_docs, 1)))).alias("_share")
    )
    observed = entries(train).groupBy("term_id", label_col).agg(F.sum("w").alias("_o"))
    return (
        observed.join(broadcast_if_small(shares), label_col)
        .groupBy("term_id")
        .agg(
            F.sum(F.col("_o") * F.col("_o") / F.col("_share")).alias("_s"),
            F.sum("_o").alias("_w"),
        )
        .select("term_id", (F.col("_s") / F.col("_w") - F.col("_w")).alias("chi2"))
    )


def best_terms(scores: DataFrame, vocab: DataFrame, k: int) -> DataFrame:
    """Top ``k`` terms by score, ties to the smaller term; ``k`` may exceed the rest.

    The score of the last is found by counting; only terms that reach it are named and sorted.
    """
    scores = stage(scores.withColumn("_key", F.expr("try_cast(round(chi2, 6) * 1000000 AS bigint)")), "scores")
    known = largest(scores.filter("_key is not null"), F.col("_key"), k)
    reached = known.unionByName(scores.filter("_key is null")).drop("_key")
    named = reached.join(broadcast_if_small(vocab, "term_id", "term"), "term_id")
    order = [F.round("chi2", 6).desc(), F.col("term").asc()]
    return stage(ranked(named, order, "rank", k), "selected")


def _kept_in_row(vectors: DataFrame, known: pa.Table, keep: list[str]) -> DataFrame:
    """Entries on the selected terms, unit again, without leaving the row."""
    sent = vectors.sparkSession.sparkContext.broadcast(known.combine_chunks())

    def run(batches):
        chosen = sent.value.column("term_id").combine_chunks()
        for batch in batches:
            lists = batch.column("vec")
            flat, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
            real = pc.is_in(pc.struct_field(flat, 0), value_set=chosen)
            kept, rows = flat.filter(real), np.asarray(rows.filter(real))
            w = np.asarray(pc.struct_field(kept, 1))
            norm = np.sqrt(np.bincount(rows, w * w, minlength=batch.num_rows))
            w = w / np.where(norm == 0, 1.0, norm)[rows]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))]).astype(np.int32)
            entry = pa.StructArray.from_arrays([pc.struct_field(kept, 0), pa.array(w)], names=["term_id", "w"])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.ListArray.from_arrays(offsets, entry)], names=[*keep, "vec"]
            )

    rows = vectors.select(*keep, "vec")
    return rows.mapInArrow(run, rows.schema)


def keep_terms(
    vectors: DataFrame, selected: DataFrame, name: str = "selected-vectors", limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Keep the selected terms and renormalise every row; null and repeated ids are rows of their own."""
    keep = [c for c in vectors.columns if c != "vec"]
    known = collected_if_small(selected, "term_id", limit=limit)
    if known is not None:
        return stage(_kept_in_row(vectors, known, keep), name)
    kept = in_blocks(vectors.select(*keep, "vec"), "vec", "term_id", selected.select("term_id"), ["term_id", "w"])
    return stage(kept.select(*keep, unit_vector(F.col("found")).alias("vec")), name)


def select_features(
    train: DataFrame, vocab: DataFrame, k: int, *others: DataFrame
) -> tuple[DataFrame, ...]:
    """Fit the selection on ``train`` and apply it to it and to ``others``."""
    chosen = best_terms(chi2_scores(train), vocab, k)
    return tuple(keep_terms(v, chosen) for v in (train, *others))
