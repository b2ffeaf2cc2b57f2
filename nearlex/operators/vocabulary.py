"""Fitted vocabularies: filtering, capping, indexing and IDF."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearlex.functions import expressions as ex
from nearlex.operators.bags import document_frequencies
from nearlex.operators.ranking import largest, ranked
from nearlex.session import parallelism, stage

#: Buckets of the first count and of one row of it, and entries from which on a capped vocabulary makes it.
BUCKETS = 1 << 24
CHUNK = 1 << 18
BUCKETED_ENTRIES = 4_000_000
#: Buckets looked into, as a multiple of the cap; the next is tried where the one before did not suffice.
TRIED = (2, 6)


def _bucketed(bag: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the entries as arrays, beside ``at``: the bucket of each entry."""
    at = F.transform("terms", lambda e: F.pmod(F.xxhash64(e["term"]), F.lit(BUCKETS)).cast("int"))
    return bag.select(at.alias("at"), *[F.col(f"terms.{c}").alias(c) for c in columns])


def _bucket_counts(bag: DataFrame, cap_by: str) -> DataFrame:
    """Stage ``chunk, counts``: documents or total counts of all terms of a bucket, at least those of any one of them."""
    buckets, step = BUCKETS, CHUNK

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            at = np.asarray(pc.list_flatten(batch.column("at")))
            np.add.at(total, at, np.asarray(pc.list_flatten(batch.column("tf"))) if cap_by == "total" else 1)
        for chunk in range(0, buckets, step):
            part = total[chunk : chunk + step]
            if part.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk // step], pa.int32()), "counts": pa.array([part.tobytes()], pa.binary())})

    def add(batches):
        chunk, total = None, None
        for batch in batches:
            for at, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
                if at != chunk:
                    if chunk is not None:
                        yield made(chunk, total)
                    chunk, total = at, np.zeros(step, np.int64)
                total += np.frombuffer(counts.as_buffer(), np.int64)
        if chunk is not None:
            yield made(chunk, total)

    def made(chunk, total):
        return pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "chunk int, counts binary"
    few = bag.coalesce(2 * parallelism(bag.sparkSession))
    counted = _bucketed(few, *(["tf"] if cap_by == "total" else [])).mapInArrow(count, kind)
    return stage(counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, kind), "buckets")


def _sizes(buckets: DataFrame) -> list[tuple[int, int]]:
    """Counts to twelve binary digits, rounded down, and how many buckets have them; largest first."""

    def run(batches):
        for batch in batches:
            for counts in batch.column("counts"):
                each = np.frombuffer(counts.as_buffer(), np.int64)
                shift = np.maximum(np.frexp(each.astype(float))[1] - 12, 0)
                value, n = np.unique(each >> shift << shift, return_counts=True)
                yield pa.RecordBatch.from_pydict({"value": pa.array(value), "n": pa.array(n)})

    rows = buckets.mapInArrow(run, "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n")).collect()
    return sorted(((r["value"], r["n"]) for r in rows if r["value"] > 0), reverse=True)


def _counts_in(bag: DataFrame, buckets: DataFrame, bound: int) -> DataFrame:
    """``document_frequencies`` of the terms whose bucket counts ``bound`` or more; one bit a bucket is sent."""

    def marked(batches):
        for batch in batches:
            bits = [np.packbits(np.frombuffer(c.as_buffer(), np.int64) >= bound, bitorder="little").tobytes() for c in batch.column("counts")]
            yield pa.RecordBatch.from_pydict({"chunk": batch.column("chunk"), "bits": pa.array(bits, pa.binary())})

    bits = np.zeros(BUCKETS // 8, np.uint8)
    for row in buckets.mapInArrow(marked, "chunk int, bits binary").toArrow().to_pylist():
        start = row["chunk"] * CHUNK // 8
        bits[start : start + CHUNK // 8] = np.frombuffer(row["bits"], np.uint8)
    sent = bag.sparkSession.sparkContext.broadcast(bits)

    def kept(batches):
        for batch in batches:
            at = np.asarray(pc.list_flatten(batch.column("at")))
            real = pa.array((sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))
            columns = [pc.list_flatten(batch.column(c)).filter(real) for c in ("term", "tf")]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "tf"])

    rows = _bucketed(bag, "term", "tf").mapInArrow(kept, "term string, tf bigint")
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))


def most_counted(bag: DataFrame, cap_by: str, wanted: Callable[[Column], Column], max_terms: int) -> DataFrame:
    """Stage term counts that satisfy ``wanted``, with the first ``max_terms`` by ``cap_by`` and all ties of the last.

    Terms are first counted by bucket of their hash, in one array of numbers a
    task.  No term counts more than its bucket, so if ``max_terms`` terms of the
    buckets from some bound on reach that bound, no other term is among the first,
    and the many rare terms are never shuffled.  Where they do not reach it, more
    buckets are looked into, and at last all terms are counted.
    """
    size = bag.agg(F.sum(F.size("terms"))).first()[0] or 0
    if size >= BUCKETED_ENTRIES:
        buckets = _bucket_counts(bag, cap_by)
        sizes = _sizes(buckets)
        values, reached = [v for v, _ in sizes], np.cumsum([n for _, n in sizes])
        for times in TRIED:
            at = int(np.searchsorted(reached, times * max_terms))
            if at >= len(values) or values[at] < 2:
                break
            counts = stage(_counts_in(bag, buckets, values[at]).filter(wanted(F.col("df"))), "counts")
            if counts.filter(F.col(cap_by) >= values[at]).count() >= max_terms:
                return counts
    return stage(document_frequencies(bag).filter(wanted(F.col("df"))), "counts")


def fit_vocabulary(
    bag: DataFrame,
    n_docs: int,
    *,
    min_df: int = 2,
    max_df: float | None = None,
    max_terms: int | None = None,
    cap_by: str = "df",
    idf: str = "bm25",
    held: dict | None = None,
) -> DataFrame:
    """Stage ``term, term_id, df, idf`` for the training bags.

    ``cap_by`` ranks terms by ``df`` or by ``total`` count; ties go to the
    smaller term.  ``max_df`` is a share of documents.  The cap is found by
    counting, so only the terms that stay, and ties of the last, are sorted.
    ``held`` keeps the counts for another formula on the same bags.
    """
    if idf not in ("bm25", "smooth"):
        raise ValueError("idf must be 'bm25' or 'smooth'")
    if cap_by not in ("df", "total"):
        raise ValueError("cap_by must be 'df' or 'total'")

    def wanted(df: Column) -> Column:
        return (df >= min_df) if max_df is None else (df >= min_df) & (df <= F.lit(max_df * n_docs))

    if max_terms is None:
        counts = document_frequencies(bag).filter(wanted(F.col("df")))
    else:
        held, bounds = {} if held is None else held, (n_docs, min_df, max_df, max_terms, cap_by)
        if bounds not in held:
            held[bounds] = most_counted(bag, cap_by, wanted, max_terms)
        counts = largest(held[bounds], F.col(cap_by), max_terms)
    order = [F.col(cap_by).desc(), F.col("term").asc()]
    formula = ex.idf_bm25 if idf == "bm25" else ex.idf_smooth
    vocab = ranked(counts, order, "term_id", max_terms).select(
        "term", F.col("term_id").cast("int").alias("term_id"), "df",
        formula(F.col("df"), n_docs).alias("idf"),
    )
    return stage(vocab, "vocab")
