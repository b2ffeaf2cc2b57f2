"""Array work done inside one task on one block of queries and one of documents.

Spark decides which rows meet (see ``neighbours.blocked``); these helpers only
multiply the two blocks and keep the best ``k`` documents of each query, so a
task never returns one row per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ACC_CELLS = 4_000_000
#: Share of filled cells above which a term is multiplied densely.
_DENSE_SHARE = 0.005
#: Cells of the matrix of these terms and a block's documents.
_DENSE_CELLS = 16_000_000
#: Pairs of entries formed at a time for the other terms.
_FORMED_PAIRS = 500_000
#: Share of cells that may beat the best so far up to which only these are looked at.
_FEW_CELLS = 0.05


def _sorted_by_id(table: pa.Table, column: str) -> pa.Table:
    return table.sort_by([(column, "ascending")])


def _lists(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    col = table.column("vec").combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    return sizes.astype(np.int64), pc.list_flatten(col)


def _postings(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a block ordered by term: ``terms, rows, weights``."""
    sizes, flat = _lists(table)
    terms = flat.field(0).to_numpy(zero_copy_only=False)
    weights = flat.field(1).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(terms, kind="stable")
    return terms[order], rows[order], weights[order]


def _dense(table: pa.Table) -> np.ndarray:
    sizes, flat = _lists(table)
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)


def _run_places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _sparse_products(q: pa.Table, t: pa.Table, n_t: int):
    """Yield ``first_query_row, products`` for slices of the query block.

    Terms that fill many cells are multiplied as one matrix; of the others every
    pair of entries is formed, many at a time, query by query.
    """
    t_terms, t_rows, t_w = _postings(t)
    known, starts = np.unique(t_terms, return_index=True)
    sizes = np.diff(np.append(starts, len(t_terms)))
    q_sizes, flat = _lists(q)
    # Entries of the queries by row, with the place of their term among those of the documents.
    place = np.full((known[-1] if len(known) else -1) + 2, -1, np.int32)
    place[known] = np.arange(len(known))
    q_terms = place[np.minimum(flat.field(0).to_numpy(zero_copy_only=False), len(place) - 1)]
    real = q_terms >= 0
    q_rows, q_w = np.repeat(np.arange(len(q_sizes)), q_sizes)[real], flat.field(1).to_numpy(zero_copy_only=False)[real]
    q_terms = q_terms[real]
    fill = np.bincount(q_terms, minlength=len(known)) / max(q.num_rows, 1) * sizes / max(n_t, 1)
    dense = np.flatnonzero(fill > _DENSE_SHARE)
    dense = dense[np.argsort(-fill[dense], kind="stable")[: _DENSE_CELLS // max(n_t, 1)]]
    column = np.full(len(known), -1, np.int32)
    column[dense] = np.arange(len(dense))
    right, docs = np.zeros((len(dense), n_t)), _run_places(starts[dense], sizes[dense])
    right[np.repeat(np.arange(len(dense)), sizes[dense]), t_rows[docs]] = t_w[docs]
    step = max(1, _ACC_CELLS // max(n_t, 1))
    for lo in range(0, q.num_rows, step):
        first, last = np.searchsorted(q_rows, [lo, lo + step])
        rows, terms, w = q_rows[first:last] - lo, q_terms[first:last], q_w[first:last]
        left, heavy = np.zeros((min(step, q.num_rows - lo), len(dense))), column[terms] >= 0
        left[rows[heavy], column[terms[heavy]]] = w[heavy]
        acc = left @ right
        rows, terms, w = rows[~heavy], terms[~heavy], w[~heavy]
        formed, cells, done = np.cumsum(sizes[terms]), acc.reshape(-1), 0
        while done < len(rows):
            stop = max(int(np.searchsorted(formed, (formed[done - 1] if done else 0) + _FORMED_PAIRS, "right")), done + 1)
            n = sizes[terms[done:stop]]
            docs = _run_places(starts[terms[done:stop]], n)
            np.add.at(cells, np.repeat(rows[done:stop] * n_t, n) + t_rows[docs], np.repeat(w[done:stop], n) * t_w[docs])
            done = stop
        yield lo, acc


def _dense_products(q: pa.Table, t: pa.Table, n_t: int):
    docs = _dense(t).T
    step = max(1, _ACC_CELLS // max(n_t, 1))
    for lo in range(0, q.num_rows, step):
        yield lo, _dense(q.slice(lo, step)) @ docs


def _squares(table: pa.Table) -> np.ndarray:
    sizes, flat = _lists(table)
    w = flat.field(1).to_numpy(zero_copy_only=False)
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), w * w, minlength=len(sizes))


def _best(merit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the ``k`` best columns of every row, ties to the left, best first."""
    n = merit.shape[1]
    if k < n:
        floor = np.partition(merit, n - k, axis=1)[:, n - k][:, None]
    else:
        floor = np.full((len(merit), 1), -np.inf)
    above = merit > floor
    level = (merit == floor) & (floor > -np.inf) if k < n else merit == floor
    # Of the columns on the limit, the leftmost fill what is left of the k.
    room = k - above.sum(axis=1, keepdims=True)
    few = level.sum(axis=1) > room[:, 0]
    if few.any():
        level[few] &= np.cumsum(level[few], axis=1) <= room[few]
    keep = (above | level) & (merit > -np.inf)
    rows, cols = np.nonzero(keep)
    order = np.lexsort((cols, -merit[rows, cols], rows))
    return rows[order], cols[order]


def _on_terms(table: pa.Table, terms: np.ndarray) -> pa.Table:
    """Only the entries of a sparse table on the ascending ``terms``."""
    sizes, flat = _lists(table)
    if not len(terms):
        real = np.zeros(len(flat), bool)
    else:
        at = flat.field(0).to_numpy(zero_copy_only=False)
        known = np.zeros(terms[-1] + 2, bool)
        known[terms] = True
        real = known[np.minimum(at, len(known) - 1)]
    ends = np.concatenate([[0], np.cumsum(real)])[np.concatenate([[0], np.cumsum(sizes)])]
    kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat.filter(pa.array(real)))
    return table.set_column(table.schema.get_field_index("vec"), "vec", kept)


def best_in_parts(q: pa.Table, batches, by, extra, k, metric, overlapping_only, digits, rows, held):
    """The best ``k`` documents of every query in a stream of documents, as one batch a group of ``by``.

    ``rows`` documents, or ``held`` entries or numbers, are multiplied at a time,
    and only the best of each query are kept in between.
    """
    sparse = pa.types.is_struct(q.schema.field("vec").type.value_type)
    groups = q.select(by).group_by(by).aggregate([]).to_pylist() if by else [{}]
    asked, best = [], [None] * len(groups)
    for group in groups:
        part = _where(q, group)
        terms = None
        if sparse and metric == "cosine":
            terms = np.unique(_lists(part)[1].field(0).to_numpy(zero_copy_only=False))
        asked.append((part, terms))

    def search(waiting: list) -> None:
        table = pa.Table.from_batches(waiting)
        for g, group in enumerate(groups):
            part, terms = asked[g]
            docs = _where(table, group)
            if not docs.num_rows or not part.num_rows:
                continue
            docs = _sorted_by_id(docs if terms is None else _on_terms(docs, terms), "train_id")
            rows_q, rows_t, values = best_in_block(part, docs, k, metric, overlapping_only, digits)
            found = docs.select([*by, "train_id", *extra]).take(pa.array(rows_t, pa.int64()))
            found = found.append_column("_row", pa.array(rows_q, pa.int64())).append_column("_value", pa.array(values, pa.float64()))
            best[g] = found if best[g] is None else _merged(pa.concat_tables([best[g], found]), k, metric, digits)

    waiting, n_rows, n_held = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        n_rows += batch.num_rows
        n_held += pc.sum(pc.list_value_length(batch.column("vec"))).as_py() or 0
        if n_rows >= rows or n_held >= held:
            search(waiting)
            waiting, n_rows, n_held = [], 0, 0
    if waiting:
        search(waiting)
    for (part, _), found in zip(asked, best):
        if found is not None:
            found = found.append_column("query_id", part.column("query_id").take(found.column("_row")))
            yield from found.select([*by, "query_id", "train_id", *extra, "_value"]).combine_chunks().to_batches()


def _where(table: pa.Table, group: dict) -> pa.Table:
    for name, value in group.items():
        table = table.filter(pc.equal(table.column(name), value))
    return table


def _merged(found: pa.Table, k: int, metric: str, digits: int) -> pa.Table:
    """The best ``k`` rows of each query, ties to the smaller ``train_id``."""
    rows, ids, values = (found.column(c).to_numpy() for c in ("_row", "train_id", "_value"))
    merit = np.round(values, digits)
    order = np.lexsort((ids, merit if metric == "euclidean" else -merit, rows))
    starts = np.flatnonzero(np.diff(rows[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return found.take(pa.array(order[place < k])).combine_chunks()


def _beating(
    value: np.ndarray, sign: float, floor: np.ndarray, k: int, overlapping_only: bool, digits: int
) -> tuple[np.ndarray, np.ndarray] | None:
    """As ``_best``, of the few cells whose merit is above ``floor``; ``None`` if they are many."""
    # Rounding moves a value by half a digit at most, so no cell is lost before it is rounded.
    near = np.flatnonzero(sign * value > (floor - 10.0**-digits)[:, None])
    if len(near) > _FEW_CELLS * value.size:
        return None
    rows, cols = np.divmod(near, value.shape[1])
    merit = sign * np.round(value.reshape(-1)[near], digits)
    real = merit > floor[rows]
    if overlapping_only:
        real &= value.reshape(-1)[near] > 0
    return first_of_rows(rows[real], cols[real], merit[real], k)[:2]


def first_of_rows(rows: np.ndarray, cols: np.ndarray, merit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best cells of every row, ties to the left, best first, and their places in the input."""
    order = np.lexsort((cols, -merit, rows))
    starts = np.flatnonzero(np.diff(rows[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    order = order[place < k]
    return rows[order], cols[order], order


def best_in_tiles(
    q: pa.Table, t: pa.Table, k: int, metric: str, overlapping_only: bool, digits: int, tile: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_in_block`` for ``tile`` documents at a time; a later tile only adds what beats the k best so far."""
    sign = -1.0 if metric == "euclidean" else 1.0
    rows, cols, values = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    floor = np.full(q.num_rows, -np.inf)
    start, size = 0, max(tile // 8, 1)
    # Smaller tiles at first: there is nothing to beat yet, and all their cells are looked at.
    while start < t.num_rows:
        at_q, at_t, best = best_in_block(q, t.slice(start, size), k, metric, overlapping_only, digits, floor)
        at_t = np.asarray(at_t, np.int64) + start
        start, size = start + size, min(2 * size, tile)
        if not len(at_q):
            continue
        rows, cols, values = (np.concatenate(x) for x in ((rows, at_q), (cols, at_t), (values, best)))
        merit = sign * np.round(values, digits)
        rows, cols, kept = first_of_rows(rows, cols, merit, k)
        values, merit = values[kept], merit[kept]
        last = np.flatnonzero(np.diff(rows, append=-1))
        full = last[np.bincount(rows, minlength=q.num_rows)[rows[last]] == k]
        floor[rows[full]] = merit[full]
    return rows, cols, values


def best_in_block(
    q: pa.Table, t: pa.Table, k: int, metric: str, overlapping_only: bool, digits: int, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of query and document, and the value, for each query's best k.

    ``t`` must be sorted by document id: ties then go to the smaller id.  With
    ``floor`` only documents whose rounded merit is above that of their query count.
    """
    n_t = t.num_rows
    sparse = pa.types.is_struct(q.schema.field("vec").type.value_type)
    products = _sparse_products if sparse else _dense_products
    sign = -1.0 if metric == "euclidean" else 1.0
    if metric == "euclidean":
        q_sq, t_sq = _squares(q), _squares(t)
    out_q, out_t, out_v = [], [], []
    for lo, acc in products(q, t, n_t):
        least = None if floor is None else floor[lo : lo + len(acc)]
        value = acc
        if metric == "euclidean":
            value = np.maximum(q_sq[lo : lo + len(acc), None] + t_sq[None, :] - 2.0 * acc, 0.0)
        found = None
        if least is not None and np.isfinite(least).all():
            found = _beating(value, sign, least, k, overlapping_only and metric == "cosine", digits)
        if found is None:
            merit = sign * np.round(value, digits)
            if overlapping_only:
                merit = np.where(acc > 0, merit, -np.inf)
            if least is not None and np.isfinite(least).any():
                merit[merit <= least[:, None]] = -np.inf
            found = _best(merit, min(k, n_t))
        rows, cols = found
        out_q.append(rows + lo)
        out_t.append(cols)
        out_v.append(value[rows, cols])
    if not out_q:
        return np.array([], int), np.array([], int), np.array([], float)
    return np.concatenate(out_q), np.concatenate(out_t), np.concatenate(out_v)
