"""Exact global ranks without funnelling rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearlex.session import stage


def ranked(
    df: DataFrame, order: Sequence[Column], rank_col: str = "rank", first: int | None = None
) -> DataFrame:
    """Add the 0-based position of every row in ``order``; keep ``first`` rows.

    The rows are range-partitioned and sorted, each row notes its partition and
    its place inside it, and the partition sizes (one row per partition) are
    summed into offsets.  A plain ``orderBy().limit(n)`` sends n rows of every
    partition to one task, which fails for vocabulary-sized n.
    """
    placed = stage(
        df.orderBy(*order).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        ),
        "ranked",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of the sort, so its size is bounded by the shuffle width.
    out = placed.join(F.broadcast(offsets), "_part").withColumn(
        rank_col, (F.col("_offset") + F.col("_place")).cast("long")
    )
    if first is not None:
        out = out.filter(F.col(rank_col) < first)
    return out.drop("_part", "_place", "_offset")


#: Bits of a key that one pass over the keys settles; 2^16 counts reach the driver at most.
DIGIT_BITS = 16


def nth_smallest(df: DataFrame, key: Column, n: int) -> tuple[int, int] | None:
    """The whole number at position ``n`` of ``key`` in ascending order, and how many are smaller.

    Digit by digit: each pass counts the next 16 bits of the keys that share the
    bits found so far, combined in the map tasks, so nothing is sorted and only
    counts are shuffled.  ``None`` if there are no more than ``n`` rows; ``key``
    must not be null.
    """
    # With the sign bit turned the order is that of unsigned numbers.
    keys = df.select(key.cast("bigint").bitwiseXOR(F.lit(-(1 << 63))).alias("_key"))
    found, below = 0, 0
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        part = keys
        if shift < 64 - DIGIT_BITS:
            part = keys.filter(F.shiftrightunsigned("_key", shift + DIGIT_BITS) == F.lit(found))
        digit = F.shiftrightunsigned("_key", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        counts = sorted((r["digit"], r["count"]) for r in part.groupBy(digit.alias("digit")).count().collect())
        if below + sum(c for _, c in counts) <= n:
            return None
        for value, count in counts:
            if below + count > n:
                found = found << DIGIT_BITS | value
                break
            below += count
    return found - (1 << 63), below


def largest(df: DataFrame, key: Column, n: int) -> DataFrame:
    """``df`` without rows whose ``key`` is below the ``n``-th largest: the first ``n`` and all ties of the last.

    Sorting what is left gives the same first ``n`` rows as sorting ``df``.
    """
    if n < 1:
        return df.filter("false")
    # The complement of a number turns the order round without overflow.
    bound = nth_smallest(df, F.bitwise_not(key.cast("bigint")), n - 1)
    return df if bound is None else df.filter(key.cast("bigint") >= F.lit(~bound[0]))


def before_rank(df: DataFrame, order: Sequence[Column], n: int) -> Column:
    """Condition that holds for the first ``n`` rows in ``order``, which must tell rows apart.

    The row at position ``n`` becomes a constant, so the rows themselves are
    neither sorted nor joined.  If the first column holds whole numbers, its bound
    is found by counting and only the rows equal in it are sorted.
    """
    if n <= 0:
        return F.lit(False)
    names = [f"_o{i}" for i in range(len(order))]
    keys = df.select(*[c.alias(name) for c, name in zip(order, names)])
    kinds = dict(keys.dtypes)
    if kinds["_o0"] in ("tinyint", "smallint", "int", "bigint") and keys.filter("_o0 is null").isEmpty():
        found = nth_smallest(keys, F.col("_o0"), n)
        if found is None:
            return F.lit(True)
        value, below = found
        first = F.lit(value).cast(kinds["_o0"])
        if len(order) == 1:
            return order[0] < first
        keys, n = keys.filter(F.col("_o0") == first), n - below
    bound = ranked(keys, [F.col(name) for name in names], "_rank").filter(F.col("_rank") == n).first()
    if bound is None:
        return F.lit(True)
    here = F.struct(*[c.alias(name) for c, name in zip(order, names)])
    return here < F.struct(*[F.lit(bound[name]).cast(kinds[name]).alias(name) for name in names])


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in ``order``, which must tell rows apart."""
    return df.filter(before_rank(df, [F.col(c) for c in order], n))
