"""Weighted document vectors.

A vector table has one row per document, empty ones included:
``doc_id, ..., vec`` with ``vec`` an ``array<struct<term_id int, w double>>``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearlex.functions import expressions as ex
from nearlex.operators.rowjoin import in_blocks
from nearlex.session import BROADCAST_LIMIT_BYTES, collected_if_small, sent_if_small, stage

Weight = Callable[[Column, Column, Column], Column]


def bm25_weight(avgdl: float, k1: float = 1.2, b: float = 0.5) -> Weight:
    return lambda tf, dl, idf: ex.bm25(tf, dl, idf, avgdl, k1, b)


def sublinear_weight() -> Weight:
    return ex.sublinear


def tfidf_weight(log_tf: bool = False) -> Weight:
    return lambda tf, dl, idf: ex.tfidf(tf, idf, log_tf)


def regroup(entries: DataFrame, keep: list[str], by: Sequence[str] = ()) -> DataFrame:
    """Collect long entries (null ``term_id`` = no entry) back to unit vectors.

    The only shuffle of weighting: numeric entries, out-of-vocabulary rows
    already dissolved by the map-side combine.
    """
    entry = F.when(F.col("term_id").isNotNull(), F.struct("term_id", "w"))
    grouped = entries.groupBy(*by, keep[0]).agg(
        *[F.first(c).alias(c) for c in keep[1:]],
        F.array_sort(F.collect_list(entry)).alias("vec"),
    )
    return grouped.select(*by, *keep, ex.unit_vector(F.col("vec")).alias("vec"))


def joined_up(bag: DataFrame, vocab: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, dl, found`` for a vocabulary too large for a task: the counts of known terms with their ``term_id, idf``."""
    known = vocab.select("term", F.col("term_id").cast("int").alias("term_id"), "idf")
    return in_blocks(bag.select(*keep, "dl", "terms"), "terms", "term", known, ["term_id", "tf", "idf"])


def looked_up(bag: DataFrame, known: pa.Table, keep: list[str], weights: Sequence[Weight] = ()) -> DataFrame:
    """``keep, dl, found``: the counts of known terms with their ``term_id, idf``, by term id, inside the row.

    With ``weights`` instead ``keep, vec0, vec1, ...``: unit vectors, one for each formula.

    An Arrow step against a table whose size was checked: no row is exploded
    and nothing is shuffled.
    """
    sent = bag.sparkSession.sparkContext.broadcast(known.combine_chunks())
    fields = [f"`{c}` {kind}" for c, kind in bag.dtypes if c in keep]
    counted = dict(bag.dtypes)["terms"].split("tf:")[1].rstrip(">")
    if weights:
        made = {f"vec{i}": "array<struct<term_id:int,w:double>>" for i in range(len(weights))}
    else:
        made = {"dl": dict(bag.dtypes)["dl"], "found": f"array<struct<term_id:int,tf:{counted},idf:double>>"}

    def run(batches):
        table = sent.value
        terms = table.column("term").combine_chunks()
        term_id, inverse = (table.column(c).to_numpy() for c in ("term_id", "idf"))
        for batch in batches:
            lists = batch.column("terms")
            flat, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
            at = pc.index_in(pc.struct_field(flat, 0), value_set=terms)
            real = pc.is_valid(at)
            at, rows = (np.asarray(x.filter(real)) for x in (at, rows))
            tf = np.asarray(pc.struct_field(flat, 1).filter(real))
            ids = term_id[at].astype(np.int32)
            order = np.lexsort((ids, rows))
            at, rows, tf, ids = at[order], rows[order], tf[order], ids[order]
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))]), pa.int32())
            idf = inverse[at]
            columns = [batch.column(c) for c in keep]
            if not weights:
                entry = pa.StructArray.from_arrays([pa.array(ids), pa.array(tf), pa.array(idf)], names=["term_id", "tf", "idf"])
                columns += [batch.column("dl"), pa.ListArray.from_arrays(offsets, entry)]
            dl = batch.column("dl").to_numpy(zero_copy_only=False)[rows]
            for weight in weights:
                w = weight(tf, dl, idf)
                norm = np.sqrt(np.bincount(rows, w * w, minlength=batch.num_rows))
                entry = pa.StructArray.from_arrays([pa.array(ids), pa.array(w / np.where(norm == 0, 1.0, norm)[rows])], names=["term_id", "w"])
                columns.append(pa.ListArray.from_arrays(offsets, entry))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])

    return bag.select(*keep, "dl", "terms").mapInArrow(run, ", ".join([*fields, *[f"`{n}` {kind}" for n, kind in made.items()]]))


def _weighed_in_row(found: DataFrame, keep: list[str], weight: Weight) -> Column:
    vec = F.transform(
        "found", lambda e: F.struct(e["term_id"].alias("term_id"), weight(e["tf"], F.col("dl"), e["idf"]).alias("w"))
    )
    # Not array_sort, which calls its comparator row by row outside generated code.
    return ex.unit_vector(F.sort_array(vec)).alias("vec")


def weigh(
    bag: DataFrame, vocab: DataFrame, weight: Weight, name: str = "vectors", limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Stage L2-normalised vectors of ``bag`` under the fitted ``vocab``.

    Terms outside the vocabulary are dropped; documents without a known term
    keep an empty vector.  Null and repeated ids are rows of their own.
    """
    keep = [c for c in bag.columns if c not in ("dl", "terms")]
    known = collected_if_small(vocab, "term", "term_id", "idf", limit=limit)
    if known is not None:
        return stage(looked_up(bag, known, keep, [weight]).withColumnRenamed("vec0", "vec"), name)
    found = joined_up(bag, vocab, keep)
    return stage(found.select(*keep, _weighed_in_row(found, keep, weight)), name)


def weigh_variants(
    bag: DataFrame, vocab: DataFrame, variants: Mapping[str, Weight], limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """``weigh`` under several formulas in one job; the ``rep`` column names the formula."""
    keep = [c for c in bag.columns if c not in ("dl", "terms")]
    known = collected_if_small(vocab, "term", "term_id", "idf", limit=limit)
    if known is not None:
        found = looked_up(bag, known, keep, list(variants.values()))
        vectors = [F.col(f"vec{i}").alias("vec") for i in range(len(variants))]
    else:
        found = joined_up(bag, vocab, keep)
        vectors = [_weighed_in_row(found, keep, w) for w in variants.values()]
    variants_in_row = F.array(*[F.struct(F.lit(n).alias("rep"), v) for n, v in zip(variants, vectors)])
    return stage(found.select(*keep, F.inline(variants_in_row)).select("rep", *keep, "vec"), "variants")


def entries(vectors: DataFrame) -> DataFrame:
    """Long form ``doc_id, ..., term_id, w``; empty vectors yield no row."""
    keep = [c for c in vectors.columns if c != "vec"]
    return vectors.select(*keep, F.inline("vec"))


def named_entries(vectors: DataFrame, vocab: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Long form with the term spelled out, by a broadcast or by blocks of rows, as the vocabulary's size allows."""
    names = sent_if_small(vocab, "term_id", "term", limit=limit)
    if names is not None:
        return entries(vectors).join(names, "term_id").drop("term_id")
    keep = [c for c in vectors.columns if c != "vec"]
    spelled = in_blocks(vectors.select(*keep, "vec"), "vec", "term_id", vocab.select("term_id", "term"), ["w", "term"])
    return spelled.select(*keep, F.inline("found"))
