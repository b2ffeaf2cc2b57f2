"""Approximate nearest neighbours through balanced posting lists.

Centroids come from a bounded sample (``SAMPLE_ROWS``), halved again and again
along the line between two means at the median, so that every centroid stands
for as many sample vectors.  All rows are then indexed: a vector is posted to
the list of its nearest centroid, and also to lists whose centroid is hardly
farther (``BOUNDARY``) and does not lie behind a chosen one, so vectors near a
border are found from both sides.  Lists are cut into parts of bounded size.

Centroids (at most ``MOST_LISTS``, a fixed bound) are searched in memory through
a graph of near centroids: from a few entries a beam walks to the nearest, then
the graph is flooded through all centroids within the wanted ratio.

A query is sent to the lists whose centroid is at most ``ratio`` times as far as
its nearest one.  The ratio is measured, not set: the least that reaches the
wanted share of true neighbours among vectors of the sample, so collections with
clusters are pruned strongly and unstructured ones are searched widely.
Distances to posted vectors are exact, in double precision.

Equal vectors are one class with its k + 1 smallest ids: more can never be among
the k nearest, as ties go to the smaller id.  So a vector that a third of all rows
share is one entry of a list, and as a query it is searched once.

Edge cases: vectors that are null, empty or zero or hold null or non-finite
components take no part, nor do those whose length is not the most frequent one
(the smaller of two).  A query row leaves out itself once; other rows with its id
are candidates.  A null id is no query and comes last among ties.  With fewer
candidates than k all are returned, as every list is then searched.  An empty
table gives an empty result.  Other columns are dropped.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearlex.llm.base import bound_batches
from nearlex.session import stage

#: Sampled vectors from which centroids and the ratio are fitted.
SAMPLE_ROWS = 32_768
#: Vectors a list should hold, and the most lists there are; longer lists have more parts.
LIST_ROWS = 512
MOST_LISTS = 16_384
#: Vectors of one part of a list, and queries that meet it in one task.
PART_ROWS = 4_096
#: A list this much farther than the nearest also holds a vector, up to so many lists.
BOUNDARY = 1.05
COPIES = 4
#: Edges of a centroid in the graph, and centroids the beam holds.
DEGREE = 24
BEAM = 16
#: Share of true neighbours that the ratio must reach in the sample, and queries to measure it.
REACHED = 0.97
MEASURED = 256
SEED = 42


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to all of ``y``, by one product."""
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0.0))


def balanced_means(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` equal parts of the sample."""
    rng = np.random.default_rng(SEED)
    parts, done = [(sample, lists)], []
    while parts:
        rows, n = parts.pop()
        if n <= 1 or len(rows) <= 1:
            done.append(rows.mean(0))
            continue
        two = rows[rng.choice(len(rows), 2, replace=False)]
        for _ in range(4):
            nearer = distances(rows, two).argmin(1)
            two = np.array([rows[nearer == k].mean(0) if (nearer == k).any() else two[k] for k in range(2)])
        # Cut across the line between both means, in proportion to the lists of each side.
        order = np.argsort(rows @ (two[1] - two[0]), kind="stable")
        left = n // 2
        cut = round(len(rows) * left / n)
        parts += [(rows[order[:cut]], left), (rows[order[cut:]], n - left)]
    return np.array(done)


@dataclass
class Index:
    """Centroids, their graph (near centroids by row) and the ratio of distances that a query goes to."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    ratio: float = math.inf

    def within(self, x: np.ndarray, ratio: float, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centroid, distance) of the centroids within ``ratio`` of each row's nearest, nearest first.

        A walk over the graph, all rows at once: a beam of the nearest ``BEAM``
        centroids is expanded until it stands still, then all that are within
        the ratio, until no new one is.
        """
        n, m = len(x), len(self.centroids)
        known = np.full((n, m), np.inf)
        open_ = np.ones((n, m), bool)
        own = (self.centroids * self.centroids).sum(1)
        square = (x * x).sum(1)

        def measure(rows: np.ndarray, at: np.ndarray) -> None:
            dot = np.einsum("ij,ij->i", x[rows], self.centroids[at])
            known[rows, at] = np.sqrt(np.maximum(square[rows] + own[at] - 2.0 * dot, 0.0))

        measure(np.repeat(np.arange(n), len(self.entries)), np.tile(self.entries, n))
        width = min(max(BEAM, least), m)
        while True:
            reach = np.partition(known, width - 1, axis=1)[:, width - 1]
            limit = np.maximum(np.where(np.isfinite(reach), reach, np.inf), known.min(1) * ratio)
            rows, at = np.nonzero(open_ & np.isfinite(known) & (known <= limit[:, None]))
            if not len(rows):
                break
            open_[rows, at] = False
            rows, at = np.repeat(rows, self.graph.shape[1]), self.graph[at].ravel()
            fresh = ~np.isfinite(known[rows, at])
            pair = np.unique(rows[fresh] * m + at[fresh])
            measure(pair // m, pair % m)
        keep = known <= np.maximum(known.min(1) * ratio, np.partition(known, min(least, m) - 1, axis=1)[:, min(least, m) - 1])[:, None]
        rows, at = np.nonzero(keep & np.isfinite(known))
        order = np.lexsort((at, known[rows, at], rows))
        rows, at = rows[order], at[order]
        return rows, at, known[rows, at]

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list a vector is posted to.

        Nearest first, a list is left out if its centroid is nearer to a chosen
        centroid than to the vector: the chosen list covers that side.
        """
        rows, at, far = self.within(x, BOUNDARY, COPIES)
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        chosen_row, chosen_at = [rows[first]], [at[first]]
        held = [at[first]]
        limit = far[first] * BOUNDARY
        for k in range(1, COPIES):
            here = np.flatnonzero(place == k)
            row, centroid = rows[here], at[here]
            good = far[here] <= limit[row]
            for other in held:
                # -1 marks a place that was left out.
                o = other[row]
                between = np.linalg.norm(self.centroids[centroid] - self.centroids[np.maximum(o, 0)], axis=1)
                good &= (o < 0) | (between > far[here])
            taken = np.full(len(x), -1)
            taken[row[good]] = centroid[good]
            held.append(taken)
            chosen_row.append(row[good])
            chosen_at.append(centroid[good])
        return np.concatenate(chosen_row), np.concatenate(chosen_at)


def fit(sample: np.ndarray, total: int, k: int) -> Index:
    """Centroids, graph and ratio for ``total`` vectors, from a sample of them."""
    lists = max(1, min(math.ceil(total / LIST_ROWS), MOST_LISTS, math.ceil(len(sample) / 2)))
    centroids = balanced_means(sample, lists)
    degree = min(DEGREE, lists - 1)
    graph = np.zeros((lists, degree + 1), np.int64)
    for start in range(0, lists, 1024):
        block = distances(centroids[start : start + 1024], centroids)
        graph[start : start + 1024, :degree] = np.argsort(block, axis=1, kind="stable")[:, 1 : degree + 1]
    # The last edge makes a ring, so that every centroid can be reached.
    graph[:, degree] = (np.arange(lists) + 1) % lists
    entries = np.unique(np.linspace(0, lists - 1, min(lists, 8)).astype(np.int64))
    index = Index(centroids, graph, entries)
    if lists == 1 or len(sample) <= k + 1:
        return index
    asked = np.random.default_rng(SEED).choice(len(sample), min(MEASURED, len(sample)), replace=False)
    near = distances(sample[asked], sample)
    near[np.arange(len(asked)), asked] = np.inf
    true = np.argpartition(near, k - 1, axis=1)[:, :k]
    far = distances(sample[asked], centroids)
    ratios = far / np.maximum(far.min(1), 1e-300)[:, None]
    row, posted = index.lists(sample[true.ravel()])
    needed = np.full(true.size, np.inf)
    np.minimum.at(needed, row, ratios[row // k, posted])
    index.ratio = float(np.quantile(needed, REACHED, method="higher"))
    return index


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, vec) of the rows that take part, and the number of components."""
    vec = F.transform(vector_col, lambda v: v.cast("double"))
    fine = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec")).filter(
        F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
        & F.exists("vec", lambda v: v != 0)
    )
    lengths = fine.groupBy(F.size("vec").alias("size")).count()
    # One row for each length; only the first is read.
    most = lengths.orderBy(F.col("count").desc(), "size").first()
    size = int(most["size"]) if most else 0
    return fine.filter(F.size("vec") == size), size


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(cls, vec, ids): distinct vectors with their ``k + 1`` smallest ids, null last; a hash tells classes apart."""
    keyed = rows.select(F.xxhash64("vec").alias("cls"), "vec", "vec_id")
    # Ranked in the map tasks already, so a frequent vector sends k + 1 rows of each.
    place = F.row_number().over(Window.partitionBy("cls", "vec").orderBy(F.col("vec_id").asc_nulls_last()))
    few = keyed.withColumn("_place", place).filter(F.col("_place") <= k + 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("_place", "vec_id"))), lambda s: s["vec_id"])
    return few.groupBy("cls", "vec").agg(ids.alias("ids"))


def _sampled(found: DataFrame, total: int, size: int) -> np.ndarray:
    """At most ``SAMPLE_ROWS`` vectors, chosen by hash."""
    share = min(1.0, 0.95 * SAMPLE_ROWS / max(total, 1))
    chosen = found if total <= SAMPLE_ROWS else found.filter(
        F.pmod(F.xxhash64("cls"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    )
    got = chosen.select("cls", F.transform("vec", lambda v: v.cast("float")).alias("vec")).limit(SAMPLE_ROWS).toArrow()
    order = np.argsort(got.column("cls").to_numpy(), kind="stable")
    return _matrix(got.column("vec").combine_chunks(), size)[order]


def search(
    rows: DataFrame, asked: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found for every row of ``asked``, which are rows of ``rows``."""
    spark = rows.sparkSession
    bound_batches(spark)
    fine, size = valid_vectors(rows, id_col, vector_col)
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not size:
        return empty
    found = stage(classes(fine, k), "classes")
    total = found.count()
    index = fit(_sampled(found, total, size), total, k)
    # At most MOST_LISTS centroids and their edges.
    sent = spark.sparkContext.broadcast(index)

    def post(batches):
        for batch in batches:
            row, at = sent.value.lists(_matrix(batch.column("vec"), size))
            yield _posted(batch, row, at)

    def probe(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"), size)
            row, at, _ = sent.value.within(x, sent.value.ratio)
            yield _posted(batch, row, at)

    kind = "cls bigint, vec array<double>, list int"
    posted = stage(
        found.mapInArrow(post, f"{kind.replace(', list', ', ids array<bigint>, list')}"), "posting-lists"
    )
    queries = valid_vectors(asked, id_col, vector_col)[0].filter(F.size("vec") == size)
    queries = stage(queries.select("vec_id", F.xxhash64("vec").alias("cls"), "vec"), "queries")
    # Any one of equal vectors stands for them.
    single = queries.groupBy("cls", "vec").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    probed = stage(single.mapInArrow(probe, kind), "probes")
    # One row for each list.
    sizes = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("_tp"))
    asks = probed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("_qp"))
    parts = F.broadcast(stage(sizes.join(asks, "list"), "parts"))
    cell = ["list", "_t", "_q"]
    own = lambda parts: F.pmod(F.hash("cls"), F.col(parts)).alias
    every = lambda parts, name: F.explode(F.sequence(F.lit(0), F.col(parts) - 1)).alias(name)
    left = probed.join(parts, "list").select(
        F.col("cls").alias("q"), F.col("vec").alias("qv"), F.col("list").alias("list"), own("_qp")("_q"), every("_tp", "_t")
    )
    right = posted.join(parts, "list").select(
        F.col("cls").alias("c"), F.col("vec").alias("cv"), F.col("ids").alias("ids"), F.col("list").alias("list"),
        own("_tp")("_t"), every("_qp", "_q"),
    )
    near = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        lambda a, b: _nearest(a, b, k + 1, size), "q bigint, c bigint, score double, ids array<bigint>"
    )
    # The same class is found through every list that holds it.
    one = near.groupBy("q", "c").agg(F.min("score").alias("score"), F.any_value("ids").alias("ids"))
    first = F.row_number().over(Window.partitionBy("q").orderBy("score", F.col("ids")[0].asc_nulls_last(), "c"))
    best = one.withColumn("_first", first).filter(F.col("_first") <= k + 1)
    # k + 1 classes of k + 1 ids each hold the answer of every row with this vector.
    each = F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("score"), i.isNull().alias("none"), i.alias("vec_id")))))
    answers = best.groupBy("q").agg(F.slice(F.array_sort(each), 1, k + 1).alias("answer"))
    # Rows of a frequent query vector are dealt over parts.
    salt = F.pmod(F.hash("vec_id"), F.lit(_SALTS)).alias("_salt")
    salted = answers.select("q", "answer", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
    rows_asked = queries.select(F.col("vec_id").alias("query_id"), F.col("cls").alias("q"), salt)
    itself = F.array_position(F.transform("answer", lambda s: F.coalesce(s["vec_id"] == F.col("query_id"), F.lit(False)) & (s["score"] == 0)), F.lit(True))
    rest = F.filter("answer", lambda s, i: i + 1 != F.col("_own"))
    return (
        rows_asked.join(salted, ["q", "_salt"])
        .withColumn("_own", itself)
        .select("query_id", F.posexplode(F.slice(rest, 1, k)).alias("_at", "_s"))
        .select("query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_s.vec_id").alias("vec_id"), F.col("_s.score").alias("score"))
    )


_SALTS = 16


def _posted(batch: pa.RecordBatch, row: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    taken = batch.take(pa.array(row))
    return pa.RecordBatch.from_arrays([*taken.columns, pa.array(at, pa.int32())], names=[*taken.schema.names, "list"])


def _nearest(asked: pa.Table, held: pa.Table, k: int, size: int) -> pa.Table:
    """The ``k`` nearest classes of the cell for every query, ties to the smaller first id."""
    q, c, score, places = [], [], [], []
    if asked.num_rows and held.num_rows:
        # By first id, so that equal distances keep that order; null ids last.
        first = pc.list_element(held.column("ids"), 0)
        held = held.take(pc.sort_indices(first, null_placement="at_end"))
        x, y = (_matrix(t.column(n).combine_chunks(), size) for t, n in ((asked, "qv"), (held, "cv")))
        for start in range(0, len(x), 512):
            block = x[start : start + 512]
            rough = distances(block, y)
            kth = np.partition(rough, min(k, len(y)) - 1, axis=1)[:, min(k, len(y)) - 1]
            # The product rounds differently; whatever may be among the nearest is measured exactly.
            scale = np.sqrt(np.finfo(float).eps) * (1.0 + np.abs(block).max() + np.abs(y).max()) * size
            rows, at = np.nonzero(rough <= (kth + scale)[:, None])
            exact = np.sqrt(((block[rows] - y[at]) ** 2).sum(1))
            order = np.lexsort((at, exact, rows))
            rows, at, exact = rows[order], at[order], exact[order]
            begin = np.searchsorted(rows, rows, "left")
            keep = np.arange(len(rows)) - begin < k
            q.append(rows[keep] + start)
            places.append(at[keep])
            score.append(exact[keep])
    flat = lambda lists, kind: np.concatenate(lists) if lists else np.zeros(0, kind)
    q, places = pa.array(flat(q, np.int64)), pa.array(flat(places, np.int64))
    return pa.table(
        {
            "q": asked.column("q").take(q) if asked.num_rows else pa.array([], pa.int64()),
            "c": held.column("c").take(places) if held.num_rows else pa.array([], pa.int64()),
            "score": pa.array(flat(score, np.float64)),
            "ids": held.column("ids").take(places) if held.num_rows else pa.array([], pa.list_(pa.int64())),
        }
    )
