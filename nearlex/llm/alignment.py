"""Alignment of two tokenizations by merge-path partitioning.

Both tokenizers cut the same bytes, so each gives an ascending list of token
ends.  Merging the two lists yields everything: a distinct end closes one
overlap of an A token and a B token, and an end found in both closes a group.
The merge is divided into pieces of equal work: on every ``PIECE``-th diagonal
of the merge matrix a binary search finds how many A and how many B ends lie
before it, so pieces depend on nothing but their own slices.  A piece emits its
overlaps and common ends; a common end whose two halves fall into adjacent
pieces is found, and counted once, when the pieces are stitched.

A blank behind another character than white space ends a token of both: A's
pattern starts a match there, and no piece of B holds the word mark behind
another character (checked when the model is read).  So texts are cut into words
at such blanks, the distinct words of a batch are encoded, laid end to end and
merged, and a worker remembers the overlaps and groups of a bounded number of
words.  The groups of a text are those of its words in order.

The distinct linked id pairs of every row are written beside its groups.  Their
counts over all documents are a Spark aggregate, combined in the task before the
shuffle.  The most frequent pairs (``TABLE_PAIRS``, a fixed bound) are sent to
the tasks; counts of all others are joined.

Edge cases: null and empty texts, and texts that either tokenizer cannot give
back byte by byte, have no tokens: zeros and an empty digest.  Every row counts
as a document, repeated ids included; null ids are kept.  Ties for the highest
count of an A id are all best.  An empty table gives an empty result.  Other
columns of ``docs`` are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearlex.llm.base import bound_batches, texts
from nearlex.session import stage

#: Ends merged by one piece.
PIECE = 1 << 16
#: Linked pairs whose counts are sent to every task; the others are joined.
TABLE_PAIRS = 1 << 18
#: Pairs a task holds before it emits their counts.
HELD_PAIRS = 3_000_000
#: Words, and characters in them, that a worker remembers before its table is emptied.
REMEMBERED = 400_000
REMEMBERED_CHARACTERS = 8_000_000
#: Words that B encodes in one call.
TOGETHER = 64
#: Bytes of text that are aligned together.
ABREAST_BYTES = 2 * 1024 * 1024


# -- merging ----------------------------------------------------------------------


def split_at(a: np.ndarray, b: np.ndarray, diagonal: int) -> int:
    """How many ends of ``a`` are among the first ``diagonal`` of the merge, ends of ``a`` first on ties."""
    low, high = max(0, diagonal - len(b)), min(diagonal, len(a))
    while low < high:
        middle = (low + high) // 2
        # a[middle] is taken before b[diagonal - middle - 1] exactly if it is not larger.
        if a[middle] <= b[diagonal - middle - 1]:
            low = middle + 1
        else:
            high = middle
    return low


def piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """Overlaps closed by ``a[i0:i1]`` and by ``b[j0:j1]``, and the common ends seen inside.

    An end of ``a`` overlaps the first token of ``b`` that ends there or later;
    all ends of ``b`` before the piece are smaller.  An end of ``b`` equal to one
    of ``a`` in the piece closes nothing new.  Returns A tokens, B tokens and
    whether each overlap closes a group, by end.
    """
    own, other = a[i0:i1], b[j0:j1]
    at = np.searchsorted(other, own, "left")
    common = np.zeros(len(own), bool)
    inside = at < len(other)
    common[inside] = other[at[inside]] == own[inside]
    before = np.searchsorted(own, other, "left")
    new = np.ones(len(other), bool)
    inside = before < len(own)
    new[inside] = own[before[inside]] != other[inside]
    left = np.concatenate([np.arange(i0, i1), i0 + before[new]])
    right = np.concatenate([j0 + at, j0 + np.flatnonzero(new)])
    closes = np.concatenate([common, np.zeros(int(new.sum()), bool)])
    order = np.lexsort((right, left))
    return left[order], right[order], closes[order]


def merged(a: np.ndarray, b: np.ndarray, size: int = PIECE):
    """Overlaps (A token, B token, closes a group) of two lists of ends, from independent pieces."""
    total = len(a) + len(b)
    diagonals = [*range(0, total, size), total]
    cuts = [split_at(a, b, d) for d in diagonals]
    parts = [
        piece(a, b, i0, i1, d0 - i0, d1 - i1)
        for d0, d1, i0, i1 in zip(diagonals, diagonals[1:], cuts, cuts[1:])
    ]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    # Stitch: if a border divides a common end, its A half is the last overlap
    # before the border and its B half the first behind it, emitted once too often.
    for k in range(1, len(parts)):
        i, j = cuts[k], diagonals[k] - cuts[k]
        if i and j < len(b) and a[i - 1] == b[j]:
            left, right, closes = parts[k]
            again = right == j
            parts[k] = left[~again], right[~again], closes[~again]
            for left, right, closes in reversed(parts[:k]):
                here = np.flatnonzero(left == i - 1)
                if len(here):
                    closes[here[-1]] = True
                    break
    return tuple(np.concatenate(column) for column in zip(*parts))


# -- tokenizers -------------------------------------------------------------------


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(x) if x in printable else chr(next(others)) for x in range(256)]


def byte_level_ranks(content: bytes) -> dict[bytes, int]:
    """Byte string to id, from the file of a byte-level vocabulary without its special tokens.

    The id of a token must be the rank of its merge, as the merges are applied by id.
    """
    made = json.loads(content)
    byte_of = {c: x for x, c in enumerate(byte_characters())}
    special = {t["content"] for t in made.get("added_tokens", []) if t.get("special")}
    vocabulary = {t: i for t, i in made["model"]["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
    if [vocabulary[a + b] for a, b in merges] != list(range(len(vocabulary) - len(merges), len(vocabulary))):
        raise ValueError("ids do not follow the merges")
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}


class Tokenizers:
    """Both tokenizers, and the byte length of each of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes, pattern: str):
        import sentencepiece
        import tiktoken

        ranks = byte_level_ranks(a_file)
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece crosses a blank: words cannot be encoded alone")
        self.mark = self.b.piece_to_id("▁")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i, p in enumerate(pieces)
        ]
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for content, i in ranks.items():
            self.a_bytes[i] = content
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)

    def encode(self, words: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Ids of a blank and each word by both, with the place of their word, and the words without loss.

        Words to be encoded ``alone`` must stand last.  Words behind which
        a blank may be cut are encoded as one text; their tokens are told apart by
        their ends.  Words that lose bytes have no ids.
        """
        n = sum(map(alone, words))
        plain, apart = words[: len(words) - n], words[len(words) - n :]
        if plain:
            whole = " " + " ".join(plain)
            a = self.a.encode_ordinary(whole)
            lines = [" ".join(plain[k : k + TOGETHER]) for k in range(0, len(plain), TOGETHER)]
            b = list(chain.from_iterable(self.b.encode(lines, num_threads=1)))
            if b"".join(map(self.b_bytes.__getitem__, b)) != whole.encode("utf-8"):
                plain, apart = [], words
        if not plain:
            a, b, last = [], [], np.zeros(0, np.int64)
        else:
            last = np.cumsum(np.fromiter((len(w.encode("utf-8")) + 1 for w in plain), np.int64, len(plain)))
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_row, b_row = (np.searchsorted(last, np.cumsum(size)) for size in (self.a_length[a], self.b_length[b]))
        exact = np.ones(len(words), bool)
        singly = [self._word(w) for w in apart]
        exact[len(plain) :] = [x is not None for x in singly]
        for k in range(2):
            lists = [x[k] if x else [] for x in singly]
            rows = np.repeat(np.arange(len(plain), len(words)), np.fromiter(map(len, lists), np.int64, len(lists)))
            ids = np.array([i for x in lists for i in x], np.int64)
            if k == 0:
                a, a_row = np.concatenate([a, ids]), np.concatenate([a_row, rows])
            else:
                b, b_row = np.concatenate([b, ids]), np.concatenate([b_row, rows])
        return (a, a_row), (b, b_row), exact

    def _word(self, word: str) -> tuple[list[int], list[int]] | None:
        a = self.a.encode_ordinary(" " + word)
        b = self.b.encode(word) if word else [self.mark]  # B adds the blank itself, but none before nothing
        content = (" " + word).encode("utf-8")
        same = b"".join(map(self.b_bytes.__getitem__, b)) == content
        return (a, b) if same and b"".join(map(self.a_bytes.__getitem__, a)) == content else None


def alone(word: str) -> bool:
    """Whether a word must be encoded alone: a blank behind it may not be cut, or B has its word mark in it."""
    return not word or word[-1].isspace() or "▁" in word


#: White space of one character other than the blank.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
_CUT = re.compile(r"(?<=\S) ")


def cut_words(text: str) -> list[str]:
    """``text`` cut at every single blank behind another character than white space."""
    if text[:1] == " " or "  " in text or any(c in text and c + " " in text for c in _SPACES):
        return _CUT.split(text)
    return text.split(" ")


class Aligned:
    """Tokens, overlaps and groups of words (or texts) laid end to end; one row for each."""

    def __init__(self, a, b, rows: int, own: Tokenizers, size: int = PIECE):
        """``a`` and ``b``: ids of tokens and the row of each, ascending."""
        self.rows, (self.a, self.a_row), (self.b, self.b_row) = rows, a, b
        ends_a, ends_b = np.cumsum(own.a_length[self.a]), np.cumsum(own.b_length[self.b])
        self.left, self.right, self.closes = merged(ends_a, ends_b, size)
        self.link_row = self.a_row[self.left]

    def counts(self) -> np.ndarray:
        """A tokens, B tokens, groups and links of every row."""
        rows = (self.a_row, self.b_row, self.link_row[self.closes], self.link_row)
        return np.array([np.bincount(r, minlength=self.rows) for r in rows])

    def links(self, width: int) -> np.ndarray:
        """A id times ``width`` plus B id of every link, row by row."""
        return self.a[self.left] * width + self.b[self.right]

    def group_texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2`` of every row."""
        if not len(self.left):
            return [""] * self.rows
        # Groups are numbered across rows; the end of a row always closes one.
        last_a, last_b = self.left[self.closes], self.right[self.closes]
        ends_a, ends_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        ends_a[last_a] = True
        ends_b[last_b] = True
        group_a = np.cumsum(ends_a) - ends_a
        group_b = np.cumsum(ends_b) - ends_b
        before_b = np.concatenate([[0], last_b + 1])[group_a]
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + before_b] = _spelled(self.a, ends_a, "|")
        out[np.arange(len(self.b)) + (last_a + 1)[group_b]] = _spelled(self.b, ends_b, ";")
        ends = np.cumsum(np.bincount(self.a_row, minlength=self.rows) + np.bincount(self.b_row, minlength=self.rows))
        tokens = out.tolist()
        return ["".join(tokens[start:end])[:-1] for start, end in zip([0, *ends[:-1].tolist()], ends.tolist())]


_SPELLED: dict[str, np.ndarray] = {}


def _spelled(ids: np.ndarray, last: np.ndarray, mark: str) -> np.ndarray:
    """Decimal ids, each followed by a comma or, at the end of a group, by ``mark``."""
    top = int(ids.max()) + 1
    table = _SPELLED.get(mark)
    if table is None or len(table) < 2 * top:
        table = np.array([f"{i // 2}{(',', mark)[i % 2]}" for i in range(2 * top)], object)
        _SPELLED[mark] = table
    return table[2 * ids + last]


class Table:
    """What a worker remembers of words: counts, group texts and links."""

    def __init__(self, own: Tokenizers):
        self.own, self.width = own, len(own.b_bytes)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.characters = 0
        self.counts = np.zeros((4, 0), np.int64)
        self.exact = np.zeros(0, bool)
        self.groups: list[str] = []
        self.links = np.zeros(0, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Places of ``words`` in the table; words not met before are encoded and merged together."""
        if len(self.known) > REMEMBERED or self.characters > REMEMBERED_CHARACTERS:
            self.forget()
        new = list(set(words).difference(self.known))
        if new:
            new.sort(key=alone)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.characters += sum(map(len, new))
            a, b, exact = self.own.encode(new)
            made = Aligned(a, b, len(new), self.own)
            self.counts = np.concatenate([self.counts, made.counts()], axis=1)
            self.exact = np.concatenate([self.exact, exact])
            self.groups += made.group_texts()
            self.links = np.concatenate([self.links, made.links(self.width)])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def rows(self, given: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Counts, group texts, and the distinct pairs with their row and number of links."""
        cut = [cut_words(t) if t else [] for t in given]
        at = self.numbers([w for words in cut for w in words])
        size = np.fromiter(map(len, cut), np.int64, len(cut))
        row = np.repeat(np.arange(len(cut)), size)
        ends = np.cumsum(size)
        bad = np.bincount(row[~self.exact[at]], minlength=len(cut)) > 0
        spelled = [
            "" if wrong else ";".join(map(self.groups.__getitem__, at[start:end].tolist()))
            for wrong, start, end in zip(bad.tolist(), [0, *ends[:-1].tolist()], ends.tolist())
        ]
        at, row = at[~bad[row]], row[~bad[row]]
        counts = np.array([np.bincount(row, c, minlength=len(cut)) for c in self.counts[:, at]]).astype(np.int64)
        held, first = self.counts[3], np.cumsum(self.counts[3]) - self.counts[3]
        take = held[at]
        place = np.arange(take.sum()) + np.repeat(first[at] - (np.cumsum(take) - take), take)
        # Row and pair in one number: rows of a portion and two vocabularies need under 63 bits.
        top = len(self.own.a_bytes) * self.width
        both = np.sort(np.repeat(row, take) * top + self.links[place])
        starts = np.flatnonzero(np.diff(both, prepend=-1))
        times = np.diff(np.append(starts, len(both)))
        return counts, spelled, both[starts] % top, both[starts] // top, times


_HELD: dict[tuple[int, int, str], Table] = {}


def remembered(a_file: bytes, b_file: bytes, pattern: str) -> Table:
    """The table of a worker, made once for each pair of files."""
    key = (hash(a_file), hash(b_file), pattern)
    if key not in _HELD:
        _HELD[key] = Table(Tokenizers(a_file, b_file, pattern))
    return _HELD[key]


def _portions(batches, *names: str) -> Iterator[tuple[list[str], dict[str, pa.Array]]]:
    """Texts in portions of bounded size beside the columns ``names``."""
    for batch in batches:
        given = texts(batch)
        size = np.cumsum([len(t) for t in given]) if given else np.zeros(0, np.int64)
        start = 0
        while start < len(given):
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + ABREAST_BYTES, "right")))
            yield given[start:stop], {n: batch.column(n).slice(start, stop - start) for n in names}
            start = stop


# -- Spark ------------------------------------------------------------------------

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, a_file: str, b_file: str, pattern: str) -> DataFrame:
    """doc_id, the four counts, the groups' digest, and distinct linked ids (``a``, ``b``) with their ``times``.

    ``_row`` tells rows apart.
    """
    bound_batches(docs.sparkSession)
    # Two files of fixed size, 2 MB.
    files = docs.sparkSession.sparkContext.broadcast((Path(a_file).read_bytes(), Path(b_file).read_bytes()))

    def run(batches):
        table = remembered(*files.value, pattern)
        for given, held in _portions(batches, "_row", "doc_id"):
            counts, spelled, pair, row, times = table.rows(given)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(given)))]), pa.int32())
            columns = {
                **held, **{c: pa.array(v, pa.int64()) for c, v in zip(COUNTS, counts)},
                "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in spelled]),
            }
            for name, values in (("a", pair // table.width), ("b", pair % table.width), ("times", times)):
                columns[name] = pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = dict(docs.dtypes)["doc_id"]
    schema = ", ".join(
        [f"_row bigint, doc_id {kind}", *[f"{c} bigint" for c in COUNTS], "groups_sha256 string"]
        + [f"{c} array<int>" for c in ("a", "b", "times")]
    )
    return docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text").mapInArrow(run, schema)


def _ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return pc.list_flatten(batch.column(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n): rows in which A id ``a`` and B id ``b`` are linked."""

    def count(batches):
        held, size = [], 0

        def emitted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
            made = [pa.array(keys >> 32, pa.int32()), pa.array(keys & 0xFFFFFFFF, pa.int32()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(made, names=["a", "b", "n"])

        for batch in batches:
            held.append((_ids(batch, "a") << 32) | _ids(batch, "b"))
            size += len(held[-1])
            if size > HELD_PAIRS:
                yield emitted()
                held, size = [], 0
        yield emitted()

    return rows.select("a", "b").mapInArrow(count, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Pairs of the largest counts, at most ``limit``: keys, counts, best of their A id; whether these are all."""
    classes = counts.groupBy(F.length(F.bin("n")).alias("c")).count().orderBy(F.col("c").desc()).collect()
    total, least = 0, None
    for row in classes:  # one row for each number of binary digits
        total += row["count"]
        if total > limit:
            break
        least = row["c"]
    chosen = counts.filter("false") if least is None else counts.filter(F.col("n") >= F.lit(2 ** (least - 1)))
    got = chosen.select("a", "b", "n", "best").toArrow()
    a, b, n, best = (got.column(c).to_numpy() for c in got.column_names)
    keys = (a.astype(np.int64) << 32) | b
    order = np.argsort(keys)
    return keys[order], n[order], best[order], total <= limit


def align(docs: DataFrame, a_file: str, b_file: str, pattern: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Token, group and link counts of every row, and how common its links are in all documents.

    ``a_file`` is a byte-level vocabulary with its ``pattern`` of matches,
    ``b_file`` a piece model.  Returns doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum and groups_sha256.
    """
    rows = stage(aligned(docs, a_file, b_file, pattern), "aligned")
    counts = stage(pair_counts(rows), "pairs")
    # One row for each id of a vocabulary, which the vocabulary's file bounds.
    highest = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("highest")))
    counts = stage(
        counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best")), "pair-counts"
    )
    *frequent, every = _frequent(counts, table_pairs)
    table = docs.sparkSession.sparkContext.broadcast(tuple(frequent))
    names = ["doc_id", *COUNTS, "groups_sha256"]

    def score(batches):
        keys, n, best = table.value
        for batch in batches:
            key = (_ids(batch, "a") << 32) | _ids(batch, "b")
            row = np.asarray(pc.list_parent_indices(batch.column("a"))).astype(np.int64)
            times = _ids(batch, "times")
            at = np.searchsorted(keys, key)
            found = at < len(keys)
            found[found] = keys[at[found]] == key[found]
            at = at[found]
            sums, bests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, row[found], times[found] * n[at])
            np.add.at(bests, row[found], times[found] * best[at])
            columns = {c: batch.column(c) for c in ("_row", *names)}
            columns |= {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=batch.num_rows))])
            for name, values in (("a", key >> 32), ("b", key & 0xFFFFFFFF), ("times", times)):
                columns[name] = pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(values[~found], pa.int32()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kinds = dict(rows.dtypes)
    fields = [*[(c, kinds[c]) for c in ("_row", *names)], ("n_best", "bigint"), ("count_sum", "bigint")]
    fields += [(c, "array<int>") for c in ("a", "b", "times")]
    scored = rows.mapInArrow(score, ", ".join(f"{c} {kind}" for c, kind in fields))
    results = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
    if every:
        return scored.select(*results)
    scored = stage(scored, "scored")
    rare = scored.select("_row", F.inline(F.arrays_zip("a", "b", "times"))).join(counts, ["a", "b"])
    rest = rare.groupBy("_row").agg(
        F.sum(F.col("times") * F.col("best").cast("bigint")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    more = rest.select("_row", F.col("n_best").alias("_best"), F.col("count_sum").alias("_sum"))
    added = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0).cast("bigint"))).alias(c)
    sums = {"n_best": added("n_best", "_best"), "count_sum": added("count_sum", "_sum")}
    return scored.join(more, "_row", "left").select(*[sums.get(c, F.col(c)) for c in results])
