"""Exact nearest neighbours between two vector tables.

Four plans:

``scan``    few queries go to all tasks, and the documents are read once where they
            are; a task returns only the best k documents of each query.

``join``    an inverted-index equi-join on the term, heavy terms salted.  Used
            when the measured number of posting pairs is linear in the input.
``blocks``  both tables are cut into blocks by a hash of the id and every block
            pair is multiplied in its own task, which returns only the best k
            documents per query.  No pair is emitted, no key can be hot, and a
            task's memory is set by the block sizes.

``pruned``  as ``blocks``, but documents are blocked by norm and content and a query
            travels only to blocks whose bound reaches its k-th value so far.

``auto`` measures the queries, then counts the posting pairs, and picks one; all
give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearlex.operators.vectors import entries
from nearlex.session import bound_batches, broadcast_if_small, collected_if_small, parallelism, stage

#: Similarities and squared distances are compared after rounding to this many digits.
DIGITS = 6
#: Posting pairs per input entry up to which the inverted join is used.
PAIRS_PER_ENTRY = 8
#: Rows of either side of one term that meet in one cell of a split term.
ROWS_PER_SALT = 1_500
#: Copied rows that one task of the block plan receives.
ROWS_PER_TASK = 100_000
#: Queries of a block, their entries or numbers, and the neighbours held for them.
QUERY_BLOCK_ROWS = 65_536
QUERY_BLOCK_ENTRIES = 2_000_000
QUERY_BLOCK_FOUND = 1_000_000
#: Documents of a block, and their entries or numbers.
TRAIN_BLOCK_ROWS = 262_144
TRAIN_BLOCK_ENTRIES = 8_000_000
#: Pairs of blocks for each task slot; where large blocks give fewer, they are cut on.
CELLS_PER_SLOT = 4
#: Documents of a block that are multiplied at a time, so that many queries are with them.
TILE_ROWS = 8_192
#: Documents from which blocks are chosen by bounds; below, all blocks are few.
PRUNED_ROWS = 524_288
#: Queries and documents of a block that is chosen by bounds.
PRUNED_QUERY_ROWS = 4_096
PRUNED_BLOCK_ROWS = 65_536
#: Queries, bytes of queries, and rows that a task returns, up to which documents are scanned.
SCAN_QUERIES = 4_096
SCAN_BYTES = 16 * 1024 * 1024
SCAN_FOUND = 65_536
#: Documents, and entries or numbers of theirs, that a scan multiplies at a time.
SCAN_ROWS = 8_192
SCAN_ENTRIES = 1_000_000


def _is_sparse(vectors: DataFrame) -> bool:
    return isinstance(vectors.schema["vec"].dataType.elementType, T.StructType)


def _extra(train: DataFrame) -> list[str]:
    return ["label"] if "label" in train.columns else []


def posting_pairs(queries: DataFrame, train: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Documents per term on both sides and the pairs an inverted join would form."""
    keys = [*by, "term_id"]
    q = entries(queries).groupBy(*keys).agg(F.count(F.lit(1)).alias("df_q"))
    t = entries(train).groupBy(*keys).agg(F.count(F.lit(1)).alias("df_t"))
    return q.join(t, keys).withColumn("pairs", F.col("df_q") * F.col("df_t"))


def pair_totals(queries: DataFrame, train: DataFrame, by: Sequence[str] = ()) -> tuple[int, int, int]:
    """Posting pairs in all, of the heaviest term, and the entries forming them."""
    row = posting_pairs(queries, train, by).agg(
        F.sum("pairs"), F.max("pairs"), F.sum(F.col("df_q") + F.col("df_t"))
    ).first()
    return tuple(int(x or 0) for x in row)


def choose_plan(queries: DataFrame, train: DataFrame, by: Sequence[str] = ()) -> str:
    if not _is_sparse(train):
        return "blocks"
    pairs, _, held = pair_totals(queries, train, by)
    return "join" if pairs <= PAIRS_PER_ENTRY * held else "blocks"


def dot_products(
    queries: DataFrame, train: DataFrame, by: Sequence[str] = (), heaviest: int | None = None
) -> DataFrame:
    """``query_id, train_id, [label], dot`` for every pair sharing a term.

    A term with very many pairs is split on both sides: its queries and its
    documents are dealt over parts of bounded size, and each side is repeated
    once per part of the other.  With one query only its own row is repeated, so
    the copies stay in proportion to the longer side.  ``heaviest`` is the pair
    count of the largest term, if already known.
    """
    extra = _extra(train)
    if heaviest is None:
        heaviest = pair_totals(queries, train, by)[1]
    q = entries(queries.select(*by, F.col("doc_id").alias("query_id"), "vec"))
    t = entries(train.select(*by, F.col("doc_id").alias("train_id"), *extra, "vec"))
    keys = [*by, "term_id"]
    if heaviest > ROWS_PER_SALT**2:
        heavy = stage(
            posting_pairs(queries, train, by)
            .filter(F.col("pairs") > ROWS_PER_SALT**2)
            .select(
                *keys, *[F.ceil(F.col(n) / ROWS_PER_SALT).cast("int").alias(p) for n, p in (("df_q", "_qp"), ("df_t", "_tp"))]
            ),
            "heavy-terms",
        )
        salts = broadcast_if_small(heavy)

        def dealt(rows: DataFrame, row_id: str, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
            parts = [F.coalesce(p, F.lit(1)) for p in (own_parts, other_parts)]
            return (
                rows.join(salts, keys, "left")
                .withColumn(own, F.pmod(F.xxhash64(row_id), parts[0]).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), parts[1] - 1)))
                .drop("_qp", "_tp")
            )

        q = dealt(q, "query_id", "_qs", "_qp", "_ts", "_tp")
        t = dealt(t, "train_id", "_ts", "_tp", "_qs", "_qp")
        keys = [*keys, "_qs", "_ts"]
    q = q.withColumnRenamed("w", "_wq")
    t = t.withColumnRenamed("w", "_wt")
    return (
        q.join(t, keys)
        .groupBy(*by, "query_id", "train_id", *extra)
        .agg(F.sum(F.col("_wq") * F.col("_wt")).alias("dot"))
    )


def _order(value: str) -> Column:
    return F.col(value).asc() if value == "dist2" else F.col(value).desc()


def top_k(pairs: DataFrame, k: int, value: str = "sim", by: Sequence[str] = ()) -> DataFrame:
    """Best ``k`` rows per query, ties to the smaller ``train_id``; adds ``rank``."""
    window = Window.partitionBy(*by, "query_id").orderBy(_order(value), F.col("train_id").asc())
    return pairs.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def squared_norms(vectors: DataFrame) -> Column:
    return F.aggregate("vec", F.lit(0.0), lambda acc, e: acc + e["w"] * e["w"])


def _pool(train: DataFrame, k: int, *order: str) -> Column:
    """The first ``k`` documents as an array constant; k is a parameter, not data."""
    fields = ["doc_id", *_extra(train), *[c for c in order if c != "doc_id"]]
    rows = train.select(*fields).orderBy(*order).limit(k).collect()
    kind = T.ArrayType(T.StructType([train.schema[f] for f in fields]))
    literal = [
        F.struct(*[F.lit(r[f]).cast(train.schema[f].dataType).alias(f) for f in fields])
        for r in rows
    ]
    return F.array(*literal) if literal else F.array().cast(kind)


def fill_short(found: DataFrame, queries: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """Give queries with fewer than ``k`` overlapping documents the smallest other ids.

    Any document outside the k smallest ids loses to all of those, so k
    candidates are enough and they travel as a constant.
    """
    found = found.filter(F.col("sim") > 0)
    pool = _pool(train, k, "doc_id")
    have = found.groupBy("query_id").agg(F.collect_list("train_id").alias("_have"))
    short = (
        queries.select(F.col("doc_id").alias("query_id"))
        .join(have, "query_id", "left")
        .withColumn("_have", F.coalesce("_have", F.array().cast("array<bigint>")))
        .filter(F.size("_have") < k)
    )
    extra = _extra(train)
    rest = short.select(
        "query_id",
        F.size("_have").alias("_n"),
        F.posexplode(
            F.filter(pool, lambda p: ~F.array_contains(F.col("_have"), p["doc_id"]))
        ).alias("_pos", "_p"),
    ).filter(F.col("_n") + F.col("_pos") < k)
    filled = rest.select(
        "query_id",
        F.col("_p.doc_id").alias("train_id"),
        *[F.col(f"_p.{c}").alias(c) for c in extra],
        F.lit(0.0).alias("sim"),
        (F.col("_n") + F.col("_pos") + 1).cast("int").alias("rank"),
    )
    return found.select("query_id", "train_id", *extra, "sim", "rank").unionByName(filled)


def joined(
    queries: DataFrame, train: DataFrame, k: int, metric: str = "cosine", fill: bool = True,
    by: Sequence[str] = (), heaviest: int | None = None,
) -> DataFrame:
    """Neighbours through the inverted-index join."""
    extra = _extra(train)
    pairs = dot_products(queries, train, by, heaviest)
    if metric == "cosine":
        found = top_k(
            pairs.select(*by, "query_id", "train_id", *extra, F.round("dot", DIGITS).alias("sim")),
            k, "sim", by,
        )
        if not fill:
            return found
        return fill_short(stage(found, "found"), queries, train, k)
    q_sq = queries.select(F.col("doc_id").alias("query_id"), squared_norms(queries).alias("_qs"))
    normed = train.select("doc_id", *extra, squared_norms(train).alias("_ts"))
    t_sq = normed.select(F.col("doc_id").alias("train_id"), "_ts")
    distance = F.round(
        F.greatest(F.col("_qs") + F.col("_ts") - 2.0 * F.col("dot"), F.lit(0.0)), DIGITS
    )
    near = top_k(
        pairs.join(q_sq, "query_id").join(t_sq, "train_id").select(
            "query_id", "train_id", *extra, distance.alias("dist2")
        ),
        k, "dist2",
    )
    return with_apart(near, q_sq, normed, k)


def with_apart(near: DataFrame, q_sq: DataFrame, normed: DataFrame, k: int) -> DataFrame:
    """Squared distances to documents sharing no term beside those already found; the best ``k`` of both.

    Of such documents only the k of smallest norm can ever be chosen.  Norms are
    ordered rounded, as the distances are.
    """
    extra = _extra(normed)
    near = stage(near.select("query_id", "train_id", *extra, "dist2"), "near")
    pool = _pool(normed.withColumn("_tr", F.round("_ts", DIGITS)), k, "_tr", "doc_id", "_ts")
    have = near.groupBy("query_id").agg(F.collect_list("train_id").alias("_have"))
    apart = (
        q_sq.join(have, "query_id", "left")
        .select(
            "query_id", "_qs",
            F.explode(
                F.filter(
                    pool,
                    lambda p: ~F.array_contains(
                        F.coalesce("_have", F.array().cast("array<bigint>")), p["doc_id"]
                    ),
                )
            ).alias("_p"),
        )
        .select(
            "query_id",
            F.col("_p.doc_id").alias("train_id"),
            *[F.col(f"_p.{c}").alias(c) for c in extra],
            F.round(F.col("_qs") + F.col("_p._ts"), DIGITS).alias("dist2"),
        )
    )
    return top_k(near.unionByName(apart), k, "dist2")


def _block_counts(queries: DataFrame, train: DataFrame, by: Sequence[str] = (), k: int = 1) -> tuple[int, int, int, int, int]:
    """Rows of both sides, blocks of both sides for the largest representation, and representations.

    A representation meets only itself, so blocks are as large as its own rows
    allow; counted over all of them, every row would travel once for each.  A
    document travels once for each block of queries, so both are as large as a
    task holds, and are cut on only where there are fewer pairs than task slots
    need, each time on the side that adds fewer copies.
    """
    slots = parallelism(train.sparkSession)
    size = [F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(F.size("vec")), F.lit(0)).alias("_held")]
    totals = lambda df: df.groupBy(*by).agg(*size).agg(F.sum("_n"), F.max("_n"), F.max("_held"), F.count(F.lit(1))).first()
    n_q, most_q, held_q, _ = (int(x or 0) for x in totals(queries))
    n_t, most_t, held_t, reps = (int(x or 0) for x in totals(train))
    reps = max(reps, 1)
    q_blocks = max(1, *(math.ceil(a / b) for a, b in ((most_q, QUERY_BLOCK_ROWS), (held_q, QUERY_BLOCK_ENTRIES), (most_q * k, QUERY_BLOCK_FOUND))))
    t_blocks = max(1, *(math.ceil(a / b) for a, b in ((most_t, TRAIN_BLOCK_ROWS), (held_t, TRAIN_BLOCK_ENTRIES))))
    while reps * q_blocks * t_blocks < CELLS_PER_SLOT * slots:
        # What a further pair costs in copies, on each side.
        costs = [(most_q / q_blocks, "t")] * (t_blocks < most_t // 128) + [(most_t / t_blocks, "q")] * (q_blocks < most_q // 128)
        if not costs:
            break
        if min(costs)[1] == "t":
            t_blocks += 1
        else:
            q_blocks += 1
    return n_q, n_t, q_blocks, t_blocks, reps


def blocked(
    queries: DataFrame, train: DataFrame, k: int, metric: str = "cosine", fill: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Neighbours through block products; each row travels to the blocks it meets."""
    by, extra = list(by), _extra(train)
    n_q, n_t, q_blocks, t_blocks, reps = _block_counts(queries, train, by, k)
    # Every column gets a fresh alias: both sides may come from one stage, and a
    # cogroup must not see the same attribute twice.
    q = queries.select(
        *[F.col(c).alias(c) for c in by],
        F.col("doc_id").alias("query_id"), F.col("vec").alias("vec"),
        F.pmod(F.xxhash64("doc_id"), F.lit(q_blocks)).alias("_i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(t_blocks - 1).cast("long"))).alias("_j"),
    )
    t = train.select(
        *[F.col(c).alias(c) for c in [*by, *extra]],
        F.col("doc_id").alias("train_id"), F.col("vec").alias("vec"),
        F.pmod(F.xxhash64("doc_id"), F.lit(t_blocks)).alias("_j"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))).alias("_i"),
    )
    copies, slots = n_q * t_blocks + n_t * q_blocks, parallelism(train.sparkSession)
    # Cells are dealt by a hash: with twice as many tasks few of them share one.
    tasks = max(min(2 * reps * q_blocks * t_blocks, max(math.ceil(copies / ROWS_PER_TASK), 16 * slots)), 2 * slots)
    overlapping_only = not fill and metric == "cosine" and _is_sparse(train)
    found = _multiplied(q, t, train, k, metric, by, overlapping_only, tasks)
    return top_k(found, k, "sim" if metric == "cosine" else "dist2", by)


def _multiplied(
    q: DataFrame, t: DataFrame, train: DataFrame, k: int, metric: str, by: list[str], overlapping_only: bool, tasks: int
) -> DataFrame:
    """The best ``k`` documents of each query in every cell ``by, _i, _j`` that both sides have."""
    from nearlex.operators.kernels import _sorted_by_id, best_in_tiles

    import pyarrow as pa

    extra, cell, digits, tile = _extra(train), [*by, "_i", "_j"], DIGITS, TILE_ROWS
    value = "sim" if metric == "cosine" else "dist2"
    q, t = q.repartition(tasks, *cell), t.repartition(tasks, *cell)

    fields = [train.schema[c] for c in by]
    fields += [T.StructField("query_id", T.LongType()), T.StructField("train_id", T.LongType())]
    fields += [train.schema[c] for c in extra] + [T.StructField("_value", T.DoubleType())]
    out_schema = T.StructType(fields)

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            rows_q, rows_t, values = [], [], []
            left, right = left.slice(0, 0), right.slice(0, 0)
        else:
            right = _sorted_by_id(right, "train_id")
            rows_q, rows_t, values = best_in_tiles(left, right, k, metric, overlapping_only, digits, tile)
        rows_q, rows_t = pa.array(rows_q, pa.int64()), pa.array(rows_t, pa.int64())
        columns = {c: right.column(c).take(rows_t) for c in by}
        columns["query_id"] = left.column("query_id").take(rows_q)
        columns["train_id"] = right.column("train_id").take(rows_t)
        columns.update({c: right.column(c).take(rows_t) for c in extra})
        columns["_value"] = pa.array(values, pa.float64())
        return pa.table(columns)

    found = q.groupBy(*cell).cogroup(t.groupBy(*cell)).applyInArrow(multiply, out_schema)
    return found.withColumn(value, F.round("_value", DIGITS) + F.lit(0.0)).drop("_value")


def scanned_queries(queries: DataFrame, k: int):
    """The queries as an Arrow table if they are few and small enough for every task, else ``None``."""
    n_q = queries.count()
    if n_q > SCAN_QUERIES or n_q * k > SCAN_FOUND:
        return None
    return collected_if_small(queries, *[c for c in queries.columns if c != "label"], limit=SCAN_BYTES)


def scanned(
    asked, train: DataFrame, k: int, metric: str = "cosine", fill: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """Neighbours of the Arrow table ``asked``; documents are read once and not shuffled."""
    from nearlex.operators.kernels import best_in_parts

    import pyarrow as pa

    by, extra, digits = list(by), _extra(train), DIGITS
    value = "sim" if metric == "cosine" else "dist2"
    overlapping_only = not fill and metric == "cosine" and _is_sparse(train)
    rows, held = SCAN_ROWS, SCAN_ENTRIES
    sent = train.sparkSession.sparkContext.broadcast(asked.rename_columns({"doc_id": "query_id"}).combine_chunks())

    def search(batches):
        yield from best_in_parts(sent.value, batches, by, extra, k, metric, overlapping_only, digits, rows, held)

    fields = [train.schema[c] for c in by]
    fields += [T.StructField("query_id", T.LongType()), T.StructField("train_id", T.LongType())]
    fields += [train.schema[c] for c in extra] + [T.StructField("_value", T.DoubleType())]
    docs = train.select(*by, F.col("doc_id").cast("bigint").alias("train_id"), *extra, "vec")
    bound_batches(train.sparkSession)
    found = docs.mapInArrow(search, T.StructType(fields))
    found = found.withColumn(value, F.round("_value", DIGITS) + F.lit(0.0)).drop("_value")
    return top_k(found, k, value, by)


def content_blocks(train: DataFrame, rows: int, entries_held: int | None = None) -> DataFrame:
    """``train`` with ``_j``: documents of like norm and the same leading term are in the same block or in neighbours.

    The table is dealt once, by range, so ids may be missing or repeated.  Blocks
    that still hold more than twice ``rows`` documents, or more entries than a
    task takes, are split.
    """
    most = TRAIN_BLOCK_ENTRIES if entries_held is None else entries_held
    leading = F.array_max(F.transform("vec", lambda e: F.struct(e["w"].alias("w"), e["term_id"].alias("term_id"))))
    n, held = train.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / rows), math.ceil(held / most))
    band = F.floor(F.log2(squared_norms(train) + F.lit(1e-12)))
    order = {"_band": band, "_lead": F.coalesce(leading["term_id"], F.lit(-1))}
    placed = train.withColumns(order).repartitionByRange(blocks, "_band", "_lead", "doc_id")
    placed = stage(placed.withColumn("_j", F.spark_partition_id().cast("long")).drop(*order), "content-blocks")
    full = placed.groupBy("_j").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / (2 * rows)), F.ceil(F.sum(F.size("vec")) / most)).cast("long").alias("_parts")
    ).filter("_parts > 1")
    full = stage(full, "full-blocks")
    widest = full.agg(F.max("_parts")).first()[0]
    if widest is None:
        return placed
    part = F.pmod(F.xxhash64("doc_id", "vec"), F.coalesce("_parts", F.lit(1).cast("long")))
    split = placed.join(broadcast_if_small(full), "_j", "left")
    return stage(split.withColumn("_j", F.col("_j") * F.lit(widest) + part).drop("_parts"), "content-blocks")


def non_negative(*tables: DataFrame) -> bool:
    """Whether no weight is below zero, as the bounds of the pruned plan need."""
    least = F.min(F.array_min(F.transform("vec", lambda e: e["w"])))
    return all((table.agg(least).first()[0] or 0.0) >= 0.0 for table in tables)


def query_parts(cells: DataFrame, rows: int) -> DataFrame:
    """``cells`` (query_id, _j) with ``_i``: the queries of a block in parts of about ``rows``."""
    counted = cells.groupBy("_j").agg(F.ceil(F.count(F.lit(1)) / rows).cast("long").alias("_parts"))
    parts = broadcast_if_small(stage(counted, "query-parts"))
    return cells.join(parts, "_j").select("query_id", "_j", F.pmod(F.xxhash64("query_id"), F.col("_parts")).alias("_i"))


def pruned(
    queries: DataFrame, train: DataFrame, k: int, fill: bool = True, rows: int | None = None, metric: str = "cosine"
) -> DataFrame:
    """Neighbours through the blocks that can hold them; the same rows as ``blocked``.

    Weights are not negative, so a query's product with the largest weight of
    each term in a block bounds its similarity to every document there.  For
    distances the bound is the larger of |q|^2 + min |t|^2 - 2 product and the
    square of the gap between |q| and the block's norms.  The block of the best
    bound is searched first; its k-th value is a threshold, and a query travels
    only to the blocks whose bound reaches it.  Documents sharing no term with a
    query are added from the k of smallest id or norm.
    """
    extra, euclid = _extra(train), metric == "euclidean"
    value = "dist2" if euclid else "sim"
    blocks = content_blocks(train, rows or min(TRAIN_BLOCK_ROWS, PRUNED_BLOCK_ROWS))
    peaks = (
        blocks.select("_j", F.inline("vec")).groupBy("_j", "term_id").agg(F.max("w").alias("w"))
        .groupBy(F.col("_j").alias("doc_id")).agg(F.collect_list(F.struct("term_id", "w")).alias("vec"))
    )
    q_sq = queries.select(F.col("doc_id").alias("query_id"), squared_norms(queries).alias("_qs"))
    # The margin covers the rounding of values and the order of additions.
    margin = 2 * 10.0**-DIGITS
    bounds = dot_products(queries, stage(peaks, "peaks")).select("query_id", F.col("train_id").alias("_j"), "dot")
    if euclid:
        norms = stage(
            blocks.groupBy("_j").agg(F.min(squared_norms(blocks)).alias("_low"), F.max(squared_norms(blocks)).alias("_high")),
            "block-norms",
        )
        gap = F.greatest(F.sqrt("_low") - F.sqrt("_qs"), F.sqrt("_qs") - F.sqrt("_high"), F.lit(0.0))
        least = F.greatest(F.col("_qs") + F.col("_low") - 2.0 * F.col("dot"), gap * gap)
        bounds = bounds.join(broadcast_if_small(norms), "_j").join(q_sq, "query_id").select(
            "query_id", "_j", (F.lit(margin) - least).alias("bound")
        )
    else:
        bounds = bounds.select("query_id", "_j", (F.col("dot") + margin).alias("bound"))
    bounds = stage(bounds, "bounds")
    asked = queries.select(F.col("doc_id").alias("query_id"), "vec")
    home = bounds.groupBy("query_id").agg(F.max_by("_j", F.struct("bound", "_j")).alias("_j"))

    def search(cells: DataFrame, name: str) -> DataFrame:
        cells = stage(query_parts(cells.select("query_id", "_j"), min(QUERY_BLOCK_ROWS, PRUNED_QUERY_ROWS)), "cells")
        fresh = lambda *names: [F.col(n).alias(n) for n in names]  # noqa: E731  as in ``blocked``
        q = cells.join(asked, "query_id").select(*fresh("query_id", "vec", "_i", "_j"))
        t = blocks.join(cells.select(*fresh("_i", "_j")).distinct(), "_j").select(
            *fresh(*extra), F.col("doc_id").alias("train_id"), *fresh("vec", "_i", "_j")
        )
        tasks = max(2 * parallelism(train.sparkSession), math.ceil(cells.count() / ROWS_PER_TASK))
        return stage(_multiplied(q, t, train, k, metric, [], not euclid, tasks), name)

    first = stage(home, "home-cells")
    found = search(first, "home")
    # With fewer than k found there is no threshold yet: every block with a common term is searched.
    merit = -F.max(value) if euclid else F.min(value)
    none = F.lit(-math.inf) if euclid else F.lit(0.0)
    limit = top_k(found, k, value).groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, merit).otherwise(none).alias("_limit"))
    others = (
        bounds.join(first.withColumnRenamed("_j", "_home"), "query_id")
        .join(limit, "query_id", "left")
        .filter((F.col("_j") != F.col("_home")) & (F.col("bound") >= F.coalesce("_limit", none)))
    )
    found = top_k(found.unionByName(search(others, "others")), k, value)
    if euclid:
        normed = train.select("doc_id", *extra, squared_norms(train).alias("_ts"))
        return with_apart(found, q_sq, normed, k)
    found = stage(found, "found")
    return fill_short(found, queries, train, k) if fill else found.filter("sim > 0")


def check_ids(side: str, vectors: DataFrame, by: Sequence[str] = ()) -> None:
    """Refuse missing and repeated ids: neighbours are named by them, so no plan could tell such rows apart."""
    key = F.col("doc_id") if not by else F.when(F.col("doc_id").isNotNull(), F.struct(*by, "doc_id"))
    rows, ids = vectors.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    if rows != ids:
        raise ValueError(f"{side}: doc_id must be present and unique")


def nearest(
    queries: DataFrame, train: DataFrame, k: int, *, metric: str = "cosine", fill: bool = True,
    plan: str = "auto", by: Sequence[str] = (),
) -> DataFrame:
    """``query_id, train_id, [label], sim | dist2, rank`` of the k nearest documents.

    Both tables hold ``doc_id, vec`` (``train`` optionally ``label``), with unit
    rows for cosine.  ``fill`` also ranks documents sharing no term, at
    similarity zero, smallest id first.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if metric not in ("cosine", "euclidean"):
        raise ValueError("metric must be 'cosine' or 'euclidean'")
    if metric == "euclidean" and not _is_sparse(train):
        raise ValueError("dense Euclidean search is not offered; use cosine")
    if plan not in ("auto", "scan", "join", "blocks", "pruned"):
        raise ValueError("plan must be 'auto', 'scan', 'join', 'blocks' or 'pruned'")
    if plan == "pruned" and (by or not _is_sparse(train) or not non_negative(queries, train)):
        raise ValueError("the pruned plan is for one sparse representation without negative weights")
    whole = bool(by) and (fill or metric == "euclidean")  # needs the rest of each representation
    if plan == "join" and whole:
        raise ValueError("the join plan fills, and measures distances, for one representation at a time")
    check_ids("queries", queries, by)
    check_ids("documents", train, by)
    if plan in ("auto", "scan"):
        asked = scanned_queries(queries, k)
        if asked is not None:
            return scanned(asked, train, k, metric, fill, by)
        if plan == "scan":
            raise ValueError("the scan plan is for queries that are few and small")
    if plan == "blocks" or whole or not _is_sparse(train):
        return blocked(queries, train, k, metric, fill, by)
    if plan == "pruned" or (
        plan == "auto" and not by and train.count() > PRUNED_ROWS and non_negative(queries, train)
    ):
        return pruned(queries, train, k, fill, metric=metric)
    pairs, heaviest, held = pair_totals(queries, train, by)
    if plan == "auto" and pairs > PAIRS_PER_ENTRY * held:
        return blocked(queries, train, k, metric, fill, by)
    return joined(queries, train, k, metric, fill, by, heaviest)
