"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a hash of their id and repeated up to
``epochs`` times.  Every copy gets a virtual finish time: the words of its
source up to and including it, divided by the source's target.  The copies of
all sources are range-sorted by that time, and whole copies are taken while
their running total stays within the budget, so each source has taken its share
of any prefix, within one document.  The budget is ``budget_share`` times the
words of all documents.

Running sums use a range sort, the sums of the sort's partitions (one row per
partition and source) as offsets, and a running sum inside each partition; a
source that holds most rows stays spread over many partitions.  Only ids and
sizes are shuffled, never texts.

Edge cases: a null text has size 0.  Documents of size 0 and sources without a
word take 0.  A null source is a source of its own and sorts last.  Repeated
rows are rows of their own; those with the same id follow each other.  Extra columns are
dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearlex.session import broadcast_if_small, stage

WEIGHTS = (5, 2, 1)
EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sum(df: DataFrame, order: Sequence[Column], value: str, by: str | None = None) -> DataFrame:
    """Add ``before``: the sum of ``value`` over earlier rows in ``order``, within ``by``.

    ``order`` must start with ``by``.  The sort is staged, so offsets and rows
    see the same partitions.
    """
    placed = stage(
        df.orderBy(*order).select(
            "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")
        ),
        "placed",
    )
    keys = [by] if by else []
    # One row per partition of the sort, and at most one more per source.
    sums = placed.groupBy("_part", *keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part", *keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(broadcast_if_small(offsets), ["_part", *keys])
        .withColumn("before", (F.col("_within") + F.col("_offset")).cast("long"))
        .drop("_part", "_place", "_within", "_sum", "_offset")
    )


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, budget_share: float = 1.0
) -> DataFrame:
    """(source_key, source_size, target): one row per source.

    Targets share the budget by weight and stop at ``epochs`` times the size of
    their source.  In order of size over weight the capped sources come first,
    so the common level is found from running sums: the first source whose cap
    is not below the level of the sources from it on.
    """
    known = (
        sizes.groupBy("source_key")
        .agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
        .withColumn("_one", F.lit(0))
    )
    by_name = Window.partitionBy("_one").orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = known.select(
        "_one", "source_key", "source_size", (F.lit(float(epochs)) * F.col("source_size")).alias("cap"),
        F.get(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))).alias("weight"),
    )
    ratio = [F.asc(F.col("cap") / F.col("weight")), F.asc("source_key")]
    up_to = Window.partitionBy("_one").orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy("_one").orderBy(*ratio).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy("_one")
    level = (
        F.sum("source_size").over(whole) * F.lit(float(budget_share))
        - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    levelled = weighed.withColumn("level", level).withColumn(
        "free", F.col("cap") >= F.col("weight") * F.col("level")
    )
    first = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        Window.partitionBy("_one").orderBy(*ratio).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levelled.select(
        "source_key", "source_size",
        F.least("cap", F.col("weight") * F.coalesce(first, F.col("cap") / F.col("weight"))).alias("target"),
    )


def mixed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, budget_share: float = 1.0
) -> DataFrame:
    """doc_id, text_hash, size, source_size, target, copies, taken of every row."""
    sizes = stage(
        docs.select(
            "doc_id", "source", F.xxhash64("text").alias("text_hash"),
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("source_key"),
            words_in(F.col("text")).alias("size"),
        ),
        "sizes",
    )
    goals = stage(targets(sizes, weights, epochs, budget_share), "targets")
    shuffled = [F.col("source_key"), F.md5(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("text_hash")]
    lined = running_sum(sizes.drop("source"), shuffled, "size", "source_key").join(
        broadcast_if_small(goals), "source_key"
    )
    rows = stage(lined.withColumn("row", F.monotonically_increasing_id()), "lined")
    # finish = source words up to the end of the copy / target of the source
    copies = rows.filter("size > 0 and target > 0").select(
        "row", "source_key", "size", "doc_id",
        F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"),
        "source_size", "before", "target",
    ).select(
        "row", "source_key", "size", "doc_id", "epoch",
        ((F.col("epoch") * F.col("source_size") + F.col("before") + F.col("size")) / F.col("target")).alias("finish"),
    )
    queue = running_sum(copies, [F.col("finish"), F.col("source_key"), F.col("epoch"), F.col("doc_id"), F.col("row")], "size")
    budget = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * budget_share
    chosen = queue.filter(F.col("before") + F.col("size") <= F.lit(float(budget))).groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    return (
        rows.join(chosen, "row", "left")
        .withColumn("copies", F.coalesce("copies", F.lit(0)).cast("int"))
        .select(
            "doc_id", "text_hash", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        )
    )


def query(docs: DataFrame) -> DataFrame:
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def repeated(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, budget_share: float = 1.0) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    how_often = (
        mixed(docs, weights, epochs, budget_share)
        .filter("copies > 0")
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    )
    # Equal rows share their copies: the first takes them all.
    place = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
    joined = docs.join(how_often, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash")))
    return (
        joined.withColumn("_row", place)
        .filter("_row = 1")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(*[docs[c] for c in docs.columns])
    )


#: SQL for :func:`query` with the default parameters.
SQL = r"""
with sized as (
  select doc_id, source, coalesce('=' || source, '-') as source_key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents
), known as (
  select source_key, source, sum(size)::bigint as source_size from sized group by all
), weighed as (
  select source_key, source_size, 3.0::double * source_size as cap,
         ([5.0, 2.0, 1.0]::double[])[1 + (row_number() over (order by source asc nulls last) - 1) % 3] as weight
  from known
), levelled as (
  select *, ((sum(source_size) over ())::double
     - coalesce(sum(cap) over (order by cap / weight, source_key rows between unbounded preceding and 1 preceding), 0))
     / sum(weight) over (order by cap / weight, source_key rows between current row and unbounded following) as level
  from weighed
), common as (
  select arg_min(level, (cap / weight, source_key)) filter (where cap >= weight * level) as level from levelled
), goals as (
  select source_key, source_size, least(cap, weight * coalesce(common.level, cap / weight)) as target
  from weighed, common
), lined as (
  select doc_id, size, source_key, source_size, target,
         sum(size) over (partition by source_key order by md5(doc_id::varchar), doc_id
                         rows unbounded preceding) as upto
  from sized join goals using (source_key)
), copies as (
  select doc_id, source_key, size, epoch, (epoch * source_size + upto)::double / target as finish
  from lined, range(0, 3) t(epoch) where size > 0 and target > 0
), queue as (
  select *, sum(size) over (order by finish, source_key, epoch, doc_id rows unbounded preceding) as total from copies
), chosen as (
  select doc_id, count(*) as copies from queue where total <= (select sum(size) from sized) group by doc_id
)
select doc_id, size, source_size, target, (coalesce(copies, 0) * size)::bigint as taken
from lined left join chosen using (doc_id)
"""
