"""Document fingerprints by a threshold-scaled sketch, with SQL functions only.

The words of a text form five-word shingles.  A shingle's 64-bit hash is kept if
it lies below a fixed fraction of the hash range; a text none of whose hashes
does keeps its smallest one.  Sketches of texts of any length are comparable and
can be merged: the union of two sketches, without a value above the threshold
unless no other is left, is the sketch of both texts together.

Next documents are found without a global window: ids are cut into ranges at
existing ids, every range is one group of a window, and the first row of each
range is sent to the range before it as well (the first of all to the last).
Only one shuffle carries texts.

Edge cases: a null text is empty; an empty text, or one of white space, has an
empty sketch.  Two empty sketches have likeness 1, an empty and another one 0.
Rows sort by id, nulls first, then by text: rows with equal ids follow each
other.  A single document is its own next.  Extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



WORDS = 5
#: Kept fraction of the hash range.
FRACTION = 0.25
#: Rows of a range of ids, and the most ranges.
RANGE_ROWS = 2_000
RANGES = 4_000


def words_of(text: Column) -> Column:
    """Words between ASCII white space."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def sketch(text: Column, words: int = WORDS, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below the threshold; the smallest hash if there is none.

    A shingle is hashed from the hashes of its words.  Texts shorter than a
    shingle are one shingle.
    """
    limit = min(-(1 << 63) + int(fraction * 2.0**64), (1 << 63) - 1)
    hashed = F.transform(words_of(text), lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        shingles = F.when(
            F.size(h) >= words,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(h) - words, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]),
            ),
        ).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return shingles

    def kept(s: Column) -> Column:
        below = F.array_sort(F.array_distinct(F.filter(s, lambda v: v < limit)))
        return F.when((F.size(below) > 0) | (F.size(s) == 0), below).otherwise(F.array(F.array_min(s)))

    return _let(_let(hashed, of), kept)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def printed(hashes: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(hashes, lambda v: F.lower(F.lpad(F.hex(v), 16, "0"))), "")


def merged(one: Column, other: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two sketched texts together."""
    limit = min(-(1 << 63) + int(fraction * 2.0**64), (1 << 63) - 1)

    def kept(s: Column) -> Column:
        below = F.filter(s, lambda v: v < limit)
        return F.when((F.size(below) > 0) | (F.size(s) == 0), below).otherwise(F.array(F.array_min(s)))

    return _let(F.array_sort(F.array_union(one, other)), kept)


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    both = F.size(F.array_intersect(one, other))
    union = F.size(one) + F.size(other) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union).cast("double")


def containment(one: Column, other: Column) -> Column:
    """Estimated share of the shingles of ``one`` that ``other`` holds, 0 to 1."""
    both = F.size(F.array_intersect(one, other))
    return (
        F.when(F.size(one) > 0, both / F.size(one)).otherwise(F.when(F.size(other) == 0, 1.0).otherwise(0.0)).cast("double")
    )


def with_next(rows: DataFrame, values: list[str]) -> DataFrame:
    """``rows`` with a column ``next``: a struct of ``values`` of the row that follows by (doc_id, text)."""
    count, nulls = rows.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull())).first()
    ranges = max(1, min(RANGES, count // RANGE_ROWS))
    cuts = []
    if count > nulls:
        shares = [k / ranges for k in range(1, ranges)]
        found = rows.agg(
            F.min("doc_id").alias("least"),
            (F.percentile_approx("doc_id", shares, 20 * ranges + 10_000) if shares else F.array(F.min("doc_id"))).alias("cuts"),
        ).first()
        cuts = sorted({c for c in found["cuts"]} - {found["least"]})  # at most RANGES ids
        if nulls:
            cuts = [found["least"], *cuts]
    first_id = None if nulls or not count else found["least"]
    # Range of an id: the number of cuts not above it, by halving an array of bounded length.
    where = F.lit(0)
    if cuts:
        sorted_cuts = F.array(*[F.lit(c) for c in cuts])
        where = F.coalesce(_position(sorted_cuts, F.col("doc_id"), len(cuts)), F.lit(0))
    opens = F.coalesce(F.get(F.array(*[F.lit(c) for c in cuts]), F.col("_range") - 1) == F.col("doc_id"), F.lit(False)) if cuts else F.lit(False)
    is_first = F.col("doc_id").isNull() if first_id is None else F.coalesce(F.col("doc_id") == F.lit(first_id), F.lit(False))
    last = len(cuts)
    homes = F.concat(
        F.array(F.struct(F.col("_range").alias("home"), F.lit(0).alias("guest"))),
        F.when(opens, F.array(F.struct((F.col("_range") - 1).alias("home"), F.lit(1).alias("guest")))).otherwise(
            F.array().cast("array<struct<home:int,guest:int>>")
        ),
        F.when(is_first, F.array(F.struct(F.lit(last).alias("home"), F.lit(1).alias("guest")))).otherwise(
            F.array().cast("array<struct<home:int,guest:int>>")
        ),
    )
    dealt = rows.withColumn("_range", where.cast("int")).select("*", F.inline(homes))
    in_order = Window.partitionBy("home").orderBy("guest", F.asc_nulls_first("doc_id"), "text")
    return (
        dealt.withColumn("next", F.lead(F.struct(*values)).over(in_order)).filter("guest = 0").drop("_range", "home", "guest")
    )


def _position(sorted_values: Column, value: Column, size: int) -> Column:
    """Number of entries of a sorted array that are not above ``value``."""
    step = 1
    while step * 2 <= size:
        step *= 2
    found = F.lit(0)
    jumps = []
    while step:
        jumps.append(step)
        step //= 2
    return F.aggregate(
        F.array(*[F.lit(j) for j in jumps]),
        found,
        lambda at, jump: F.when(
            F.coalesce(F.get(sorted_values, at + jump - 1) <= value, F.lit(False)), at + jump
        ).otherwise(at),
    )


def fingerprints(docs: DataFrame, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its second half replaced by the beginning of the next
    document.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    # Only texts are shuffled: hashing them again costs less than moving sketches, which do not compress.
    paired = with_next(rows, ["text"]).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    )
    edited = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), sketch(F.col("text"), words, fraction).alias("hashes"),
        sketch(F.col("next.text"), words, fraction).alias("next_hashes"),
        F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), words, fraction).alias("edited_hashes"),
    )
    return edited.select(
        "doc_id", "n_chars", "edited_sha256",
        printed(F.col("hashes")).alias("fingerprint"),
        printed(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
        containment(F.col("hashes"), F.col("edited_hashes")).alias("held_by_edited"),
        containment(F.col("hashes"), F.col("next_hashes")).alias("held_by_next"),
    )
