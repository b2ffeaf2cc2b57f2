"""Byte-level BPE encoding and decoding by a monoid tree.

The exact merges of a byte string are an element of a monoid.  A string is
halved down to single bytes; two neighbours are joined by re-encoding a window
over their border.  A sequence of tokens is the result of the merges exactly if
every two adjacent tokens are, alone, merged into themselves (the first merge
across a border would also happen in the pair alone).  So once the pairs at both
ends of the window hold, every token outside is proved final; until then the
window grows.  Decoding concatenates byte strings up a tree.

A worker keeps words and short halves it has met in a table of bounded size.
The rank file is a parameter; its bytes travel to the workers with the task.

Edge cases: a null text is encoded as the empty text (no ids).  Rows are
independent, so repeated rows and null ids need no rule.  Other columns of
``docs`` are passed through.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from nearlex.llm.base import bound_batches, replaced, texts

#: Entries of each of a worker's tables before it is emptied (about 0.2 GB in all).
REMEMBERED = 500_000
#: Byte strings up to this length are remembered as halves.
SHORT = 6
#: Bytes of a window that is merged by scanning; longer ones use a heap.
WINDOW = 48
#: Byte strings joined at one node of the decoding tree.
FAN_IN = 64


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Byte string to rank, from the lines of a rank file."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}


class Remembered(dict):
    """Results of ``make`` by string, emptied when full; long strings are not kept."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> tuple[int, ...]:
        made = self.make(key)
        if len(key) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = made
        return made


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, content: bytes, pattern: str):
        self.ranks = read_ranks(content)
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pieces = Remembered(self.piece)
        self.words = Remembered(self.word)
        self.halves: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], tuple[int, ...]] = {}

    # -- the monoid -------------------------------------------------------

    def merged(self, data: bytes) -> tuple[int, ...]:
        """All merges of a window: the lowest rank first, leftmost among equals."""
        if len(data) > WINDOW:
            return self.merged_by_heap(data)
        rank_of, none = self.ranks.get, len(self.ranks)
        part = [data[i : i + 1] for i in range(len(data))]
        pair = [rank_of(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pair:
            best = min(pair)
            if best == none:
                break
            i = pair.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = rank_of(part[i - 1] + part[i], none)
            if i < len(pair):
                pair[i] = rank_of(part[i] + part[i + 1], none)
        return tuple([self.ranks[p] for p in part])

    def merged_by_heap(self, data: bytes) -> tuple[int, ...]:
        """The same over a linked list, so that a long window costs n log n."""
        n = len(data)
        part = [data[i : i + 1] for i in range(n)]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank_of = self.ranks.get
        heap = []
        for i in range(n - 1):
            rank = rank_of(part[i] + part[i + 1])
            if rank is not None:
                heap.append((rank, i, 2))
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            if not part[i]:
                continue
            j = after[i]
            if j >= n or len(part[i]) + len(part[j]) != size:
                continue
            part[i], part[j] = part[i] + part[j], b""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n:
                    both = part[left] + part[right]
                    rank = rank_of(both)
                    if rank is not None:
                        heapq.heappush(heap, (rank, left, len(both)))
        return tuple(self.ranks[p] for p in part if p)

    def pair(self, left: int, right: int) -> tuple[int, ...]:
        """The merges of two adjacent tokens alone."""
        held = self.pairs.get((left, right))
        if held is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            held = self.merged(self.bytes_of[left] + self.bytes_of[right])
            self.pairs[left, right] = held
        return held

    def stands(self, left: int, right: int) -> bool:
        """Whether two adjacent tokens are merged into themselves."""
        return self.pair(left, right) == (left, right)

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the concatenation of two encoded strings."""
        if not left or not right:
            return left or right
        middle = self.pair(left[-1], right[0])
        if middle == (left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            left_done = i >= len(left) or self.stands(left[-i - 1], middle[0])
            right_done = j >= len(right) or self.stands(middle[-1], right[j])
            if left_done and right_done:
                return left[: len(left) - i] + middle + right[j:]
            if not left_done:
                i = min(2 * i, len(left))
            if not right_done:
                j = min(2 * j, len(right))
            window = left[-i:] + right[:j]
            middle = self.merged(b"".join([self.bytes_of[t] for t in window]))

    def tree(self, data: bytes) -> tuple[int, ...]:
        """Encode the halves, then join them."""
        held = self.halves.get(data)
        if held is None:
            n = len(data)
            if n < 2:
                return (self.ranks[data],) if n else ()
            if n > SHORT:
                return self.join(self.tree(data[: n // 2]), self.tree(data[n // 2 :]))
            if len(self.halves) >= REMEMBERED:
                self.halves.clear()
            held = self.join(self.tree(data[: n // 2]), self.tree(data[n // 2 :]))
            self.halves[data] = held
        return held

    def piece(self, match: str) -> tuple[int, ...]:
        """One match of the pattern; a whole match that is a token stays one."""
        data = match.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else self.tree(data)

    # -- texts ------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.

        A single space between two characters other than white space always
        starts a match, so words can be looked up one by one; texts with two
        white-space characters in a row go through the pattern as a whole.
        """
        if len(" ".join(text.split())) != len(text):
            return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))
        cut = next(c for c in "\0\1\2" if c not in text or c == "\2")
        if cut == "\2":
            words = [w if i == 0 else " " + w for i, w in enumerate(text.split(" "))]
        else:
            words = text.replace(" ", cut + " ").split(cut)
        return list(chain.from_iterable(map(self.words.__getitem__, words)))

    def word(self, word: str) -> tuple[int, ...]:
        if word[1:].isalpha() and word[0] == " ":
            return self.pieces[word]
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, self.split(word))))

    def decode(self, ids: list[int]) -> bytes:
        """Concatenate the byte strings of the ids up a tree."""
        level = [self.bytes_of[i] for i in ids]
        while len(level) > 1:
            level = [b"".join(level[i : i + FAN_IN]) for i in range(0, len(level), FAN_IN)]
        return level[0] if level else b""


_CODECS: dict[str, Codec] = {}


def codec(content: bytes, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(content, pattern)
    return _CODECS[key]


OUTPUTS = {
    "ids": "array<int>", "n_tokens": "bigint", "ids_sha256": "string",
    "decoded": "string", "decoded_sha256": "string",
}


def encode(
    docs: DataFrame, rank_file: str, pattern: str, outputs: tuple[str, ...] = ("ids", "n_tokens")
) -> DataFrame:
    """``docs`` with ``text`` replaced by the chosen outputs.

    ``ids`` are the token ids, ``decoded`` the text decoded from them, and the
    digests are SHA-256 of the ids (little-endian, 32 bits) and of the decoded
    bytes.  Columns of ``docs`` with the name of an output are dropped.
    """
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(Path(rank_file).read_bytes())  # one file, about 1 MB
    kept = docs.select(*[c for c in docs.columns if c not in outputs])
    fields = [f"`{c}` {kind}" for c, kind in kept.dtypes if c != "text"]
    fields += [f"{name} {OUTPUTS[name]}" for name in outputs]
    decodes = any(name.startswith("decoded") for name in outputs)

    def run(batches):
        own = codec(sent.value, pattern)
        gc.set_threshold(200_000)  # the tables hold no cycles
        for batch in batches:
            made: dict[str, list] = {name: [] for name in outputs}
            for text in texts(batch):
                ids = own.encode(text)
                packed = np.array(ids, dtype="<u4")
                back = own.decode(ids) if decodes else b""
                for name, values in made.items():
                    if name == "ids":
                        values.append(packed)
                    elif name == "n_tokens":
                        values.append(len(ids))
                    elif name == "ids_sha256":
                        values.append(hashlib.sha256(packed.tobytes()).hexdigest())
                    elif name == "decoded":
                        values.append(back.decode("utf-8", "replace"))
                    else:
                        values.append(hashlib.sha256(back).hexdigest())
            kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
            yield replaced(
                batch, "text", **{n: pa.array(v, kinds.get(n, pa.string())) for n, v in made.items()}
            )

    return kept.mapInArrow(run, ", ".join(fields))


def decode(tokens: DataFrame, rank_file: str, pattern: str = "") -> DataFrame:
    """``tokens`` with the column ``ids`` replaced by the decoded ``text``; null ids give the empty text."""
    sent = tokens.sparkSession.sparkContext.broadcast(Path(rank_file).read_bytes())
    kept = tokens.select(*[c for c in tokens.columns if c != "text"])
    fields = [f"`{c}` {kind}" for c, kind in kept.dtypes if c != "ids"] + ["text string"]

    def run(batches):
        own = codec(sent.value, pattern)
        for batch in batches:
            made = [own.decode(ids or []).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield replaced(batch, "ids", text=pa.array(made, pa.string()))

    return kept.mapInArrow(run, ", ".join(fields))
