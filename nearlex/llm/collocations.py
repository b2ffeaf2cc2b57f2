"""Phrase collocations: frequent word sequences whose parts attract each other.

Words of a language that are frequent enough get ids by falling frequency, so
the frequent ones have small ids.  The id pairs of adjacent words are dealt to
square tiles of ``TILE`` ids a side.  A tile with many pairs is counted by
direct address, ``bincount`` over a dense array of its cells; the others as
sorted coordinates.  Frequent pairs are ranked again and become the ids of the
next level: a phrase of m + 1 words is the pair of the m-word phrases at its
place and at the next, so the same tiles count phrases of any length, and a
phrase is only counted where both of its parts are frequent.  Counts are
combined in the task and added up by Spark, one row an id pair.

``TABLE_ENTRIES`` ids of a level are sent to the tasks, a fixed bound.  If a
level has more frequent phrases, the others are known by a 64-bit hash instead
of a rank and counted as sorted coordinates without pruning, so nothing is lost.

A phrase's score is its lowest over all cuts into two parts.  The counts of its
beginnings and endings are carried from level to level by two joins, and the
arithmetic is in decimals of 38 digits: a count times the corpus' words times
1000 stays below that up to 10^17 words.  A phrase is dropped if a longer one
has it inside and is as frequent.  It is enough to look one word further: a
longer phrase with the same count has, between it and the phrase, one with one
more word and the same count.

Edge cases: a null text is empty; a null language is ``und``, as is the text
``und``.  Repeated rows count each.  Ties go by score, count and phrase, which
tell all phrases of a language apart.  A very long text is worked on whole by
one task.  An empty table gives an empty result.  Other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearlex.llm.base import bound_batches
from nearlex.operators.ranking import ranked
from nearlex.session import broadcast_if_small, stage

#: Ids on a side of a tile.
TILE = 1024
#: A tile is dense from this share of its cells.
DENSE_SHARE = 1 / 16
#: Phrases of a level whose ids are sent to the tasks.
TABLE_ENTRIES = 1 << 20
#: Words, of all languages together, or pairs a task holds before it emits their counts.
HELD_WORDS = 300_000
HELD_PAIRS = 400_000
#: Rows of a batch of counts.
COUNT_ROWS = 1 << 16
#: Word ids of a written row; it ends at the next break.  Readers and writers hold thousands of rows at a time.
ROW_IDS = 1_024
#: Bytes of text whose words are looked up together.
ABREAST_BYTES = 1024 * 1024
#: Decimals that hold every product.
WIDE = "decimal(38,0)"

_BREAKS = b",;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + _BREAKS, bytes(range(97, 123)) + b"." * len(_BREAKS)
)
#: Ids of words that end a piece, and of infrequent ones.
BREAK = -1


def words_of(text: str) -> list[bytes]:
    """Words with A to Z lower-cased; ``.`` stands alone wherever a piece ends, and is no word."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).replace(b".", b" . ").split()


def _language(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n, hash) of all words; the row with a null word counts all words of the language."""
    most = HELD_WORDS

    def count(batches):
        held: dict[str, dict[bytes | None, int]] = {}
        size = 0

        def emitted(lang: str) -> pa.RecordBatch:
            words = held.pop(lang)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(words), pa.string()),
                    pa.array(words.keys(), pa.binary()),
                    pa.array(words.values(), pa.int64()),
                    pa.array((None if w is None else word_key(lang, w) for w in words), pa.int64()),
                ],
                names=["lang", "word", "n", "hash"],
            )

        for batch in batches:
            for lang, words in _by_language(batch):
                own = held.setdefault(lang, {None: 0})
                size -= len(own)
                coded = pa.array(words, pa.binary()).dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                for word, times in zip(coded.dictionary.to_pylist(), n.tolist()):
                    if word != b".":
                        own[word] = own.get(word, 0) + times
                        own[None] += times
                size += len(own)
                if size > most:
                    largest = max(held, key=lambda name: len(held[name]))
                    size -= len(held[largest])
                    yield emitted(largest)
        for lang in list(held):
            yield emitted(lang)

    made = docs.select(_language(docs), "text").mapInArrow(
        count, "lang string, word binary, n bigint, hash bigint"
    )
    return made.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.first("hash").alias("hash"))


def _by_language(batch: pa.RecordBatch):
    """(language, words of some of its rows with a break behind each) in portions of bounded size."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        words = held.setdefault(lang, [])
        words += words_of(text or "")
        words.append(b".")
        size[lang] = size.get(lang, 0) + len(text or "")
        if size[lang] > ABREAST_BYTES:
            yield lang, held.pop(lang)
            size[lang] = 0
    yield from held.items()


def _ranked(level: DataFrame, entries: int) -> tuple[DataFrame, bool]:
    """``level`` with ids: ranks by falling count for the first ``entries`` rows, else their hash; whether all are ranks."""
    placed = ranked(level, [F.col("a").desc(), F.col("lang"), F.col("phrase")], "id")
    # Hashes lie beyond all ranks.
    hashed = F.shiftrightunsigned("hash", 1).bitwiseOR(F.lit(1 << 62))
    placed = placed.withColumn("id", F.when(F.col("id") < entries, F.col("id")).otherwise(hashed))
    placed = stage(placed, "phrases")
    return placed, placed.count() <= entries


class Lookup:
    """Ids of a level by key, for the tasks: sorted keys, their ids, and whether these are all."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, every: bool):
        order = np.argsort(keys)
        self.keys, self.ids, self.every = keys[order], ids[order], every

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The id of each key; an unknown one is infrequent if all are here, else its hash."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        found = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        other = np.int64(BREAK) if self.every else (keys.view(np.uint64) >> np.uint64(1)).astype(np.int64) | (1 << 62)
        return np.where(found, self.ids[at] if len(self.keys) else 0, other)


def _sent(level: DataFrame, entries: int, every: bool) -> Lookup:
    """At most ``entries`` rows of 16 bytes travel through the driver."""
    got = level.filter(F.col("id") < entries).select("hash", "id").toArrow()
    return Lookup(got.column("hash").to_numpy(), got.column("id").to_numpy(), every)


def word_key(lang: str, word: bytes) -> int:
    """64-bit key of a word of a language, as a signed integer."""
    value = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\x00" + word, 7)
    return value - (1 << 64) if value >> 63 else value


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit key of a pair of ids: exact for ranks, a mixed hash if either is a hash."""
    plain = (left << 31) | right
    wide = (left | right) >> 62 != 0
    if wide.any():
        mixed = left[wide].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= (right[wide].view(np.uint64) + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        plain[wide] = (mixed * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
    return plain


def next_level(ids: np.ndarray, lookup: Lookup | None) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) ids of adjacent places that both hold a phrase; with ``lookup``, their ids by place instead."""
    left, right = ids[:-1], ids[1:]
    real = (left != BREAK) & (right != BREAK)
    if lookup is None:
        return left[real], right[real]
    out = np.full(len(left), BREAK, np.int64)
    out[real] = lookup(pair_key(left[real], right[real]))
    return out, real


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (left, right) and their counts, tile by tile; hashed ids as sorted coordinates."""
    hashed = (left | right) >> 62 != 0
    out = [_coordinates(left[hashed], right[hashed])]
    left, right = left[~hashed], right[~hashed]
    side = int(max(left.max(initial=0), right.max(initial=0))) // TILE + 1
    tile = left // TILE * side + right // TILE
    cell = left % TILE * TILE + right % TILE
    # One sort puts the pairs of a tile together; cells need 20 bits.
    packed = np.sort(tile << 20 | cell)
    tile, cell = packed >> 20, packed & ((1 << 20) - 1)
    starts = np.flatnonzero(np.diff(tile, prepend=-1))
    ends = np.append(starts[1:], len(tile))
    dense = ends - starts >= TILE * TILE * DENSE_SHARE
    for start, end in zip(starts[dense], ends[dense]):
        n = np.bincount(cell[start:end], minlength=TILE * TILE)
        cells = np.flatnonzero(n)
        corner = int(tile[start])
        out.append((corner // side * TILE + cells // TILE, corner % side * TILE + cells % TILE, n[cells]))
    sparse = packed[np.repeat(~dense, ends - starts)]
    first = np.flatnonzero(np.diff(sparse, prepend=-1))
    n, sparse = np.diff(np.append(first, len(sparse))), sparse[first]
    tile, cell = sparse >> 20, sparse & ((1 << 20) - 1)
    out.append((tile // side * TILE + cell // TILE, tile % side * TILE + cell % TILE, n))
    return tuple(np.concatenate(column) for column in zip(*out))


def _coordinates(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    first = np.flatnonzero(new)
    return left[first], right[first], np.diff(np.append(first, len(left)))


def cut_at_breaks(ids: np.ndarray, size: int) -> np.ndarray:
    """Ends of rows of about ``size`` ids: each is behind a break, so no pair is in two rows; ``ids`` end with one."""
    ends = np.flatnonzero(ids == BREAK) + 1
    return ends[np.diff(ends // size, append=-1) != 0]


def sequences(docs: DataFrame, lookup: Lookup) -> DataFrame:
    """Word ids of the documents in short rows; a break stands between pieces and at the end of a row."""
    sent, size = docs.sparkSession.sparkContext.broadcast(lookup), ROW_IDS

    def run(batches):
        for batch in batches:
            made = []
            for lang, words in _by_language(batch):
                coded = pa.array(words, pa.binary()).dictionary_encode()
                spelled = coded.dictionary.to_pylist()
                keys = np.fromiter((word_key(lang, w) for w in spelled), np.int64, len(spelled))
                ids = sent.value(keys)
                ids[[k for k, w in enumerate(spelled) if w == b"."]] = BREAK
                ids = ids[coded.indices.to_numpy()]
                # Runs of breaks are one.
                made.append(ids[(ids != BREAK) | (np.concatenate([[0], ids[:-1]]) != BREAK)])
            flat = np.concatenate([np.zeros(0, np.int64), *made])
            offsets, flat = np.concatenate([[0], cut_at_breaks(flat, size)]), pa.array(flat, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], names=["ids"])

    return docs.select(_language(docs), "text").mapInArrow(run, "ids array<bigint>")


def pair_counts(words: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """(left, right, a) of adjacent phrases, where ``lookups`` lead from words to the phrases of this level."""
    sent, most, step = words.sparkSession.sparkContext.broadcast(lookups), HELD_PAIRS, COUNT_ROWS

    def count(batches):
        held, size = [], 0

        def emitted():
            none = np.zeros(0, np.int64)
            sides = [np.concatenate([none, *[h[k] for h in held]]) for k in range(2)]
            counts = tile_counts(*sides)
            for start in range(0, len(counts[0]), step):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[start : start + step], pa.int64()) for x in counts], names=["left", "right", "a"]
                )

        for batch in batches:
            # Rows end with a break, so no pair reaches into the next.
            ids = batch.column("ids").flatten().to_numpy()
            for lookup in sent.value:
                ids = next_level(ids, lookup)[0]
            held.append(next_level(ids, None))
            size += len(held[-1][0])
            if size > most:
                yield from emitted()
                held, size = [], 0
        yield from emitted()

    made = words.mapInArrow(count, "left bigint, right bigint, a bigint")
    return made.groupBy("left", "right").agg(F.sum("a").alias("a"))


def _keyed(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the key of both ids as ``hash``."""

    def run(batches):
        for batch in batches:
            key = pair_key(*(batch.column(c).to_numpy() for c in ("left", "right")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key, pa.int64())], names=[*batch.schema.names, "hash"])

    return pairs.mapInArrow(run, "left bigint, right bigint, a bigint, hash bigint")


def _described(counts: DataFrame, below: DataFrame) -> DataFrame:
    """Frequent pairs with language, phrase, and counts of their beginnings and endings."""
    head = below.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("_head"), F.col("begins").alias("_begins"))
    tail = below.select(F.col("id").alias("right"), F.col("last").alias("last"), F.col("ends").alias("_ends"))
    return counts.join(head, "left").join(tail, "right").select(
        "left", "right", "a", "hash", "lang",
        F.concat_ws(" ", "_head", "last").alias("phrase"), "last",
        F.concat("_begins", F.array("a")).alias("begins"), F.concat("_ends", F.array("a")).alias("ends"),
    )


def _scored(level: DataFrame, totals: DataFrame, words: int) -> DataFrame:
    """Score, parts and corpus size of every phrase of ``words`` words: the lowest cut, the first of equals."""
    wide = lambda c: c.cast(WIDE)
    cuts = []
    for k in range(1, words):
        left, right = F.col("begins")[k - 1], F.col("ends")[words - k - 1]
        score = F.call_function("div", wide(F.lit(1000)) * wide(F.col("a")) * wide(F.col("n")), wide(left) * wide(right))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return level.join(broadcast_if_small(totals), "lang").withColumn("_cut", F.least(*cuts) if words > 2 else cuts[0]).select(
        "lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score")
    )


def _standing(level: DataFrame, longer: DataFrame | None) -> DataFrame:
    """``level`` without phrases that are inside a phrase of one more word with the same count."""
    if longer is None:
        return level
    inside = longer.select("a", F.explode(F.array("left", "right")).alias("id")).groupBy("id").agg(F.max("a").alias("_most"))
    return level.join(inside, "id", "left").filter(F.col("_most").isNull() | (F.col("_most") < F.col("a")))


def mine(
    docs: DataFrame, least: int = 100, longest: int = 5, best: int = 2000, entries: int = TABLE_ENTRIES
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``best`` phrases of every language.

    Phrases have 2 to ``longest`` words and occur ``least`` times or more.
    """
    bound_batches(docs.sparkSession)
    counted = stage(word_counts(docs).filter(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = stage(counted.filter("word is null").select("lang", "n"), "totals")
    word, once = F.col("word").cast("string"), F.array("n")
    level, every = _ranked(
        counted.filter("word is not null").select(
            F.col("n").alias("a"), "hash", "lang", word.alias("phrase"), word.alias("last"),
            once.alias("begins"), once.alias("ends"),
        ),
        entries,
    )
    ids = stage(sequences(docs, _sent(level, entries, every)), "ids")
    levels, lookups = [], []
    for words in range(2, longest + 1):
        pairs = stage(pair_counts(ids, lookups).filter(F.col("a") >= least), "pairs")
        level, every = _ranked(_described(_keyed(pairs), level), entries)
        levels.append(level)
        if words < longest:
            lookups.append(_sent(level, entries, every))
    scored = None
    for words, (level, longer) in enumerate(zip(levels, [*levels[1:], None]), 2):
        rows = _scored(_standing(level, longer), totals, words)
        scored = rows if scored is None else scored.union(rows)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The best of each part first, so that no language is ordered in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    few = scored.withColumn("_part", part).withColumn("_first", first).filter(F.col("_first") <= best)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return few.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


#: The same rows in DuckDB.
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?
-
]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS m)),
f AS (SELECT lang, phrase, m, count(*)::BIGINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, phrase, m, a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n,
         ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN totals USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, a AS longer
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM candidates))),
kept AS (
  SELECT * FROM lowest l WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = l.lang AND i.phrase = l.phrase AND 100 * i.longer >= 100 * l.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
