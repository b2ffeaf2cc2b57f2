"""SimHash near-duplicates, linked through BK-trees of fingerprint shards.

A fingerprint bit is the majority of that bit over the 64-bit hashes of all word
shingles.  Distinct fingerprints are dealt to shards by bands of bits: with a
radius of r bits, r + 1 bands leave one band equal in every linked pair, so the
shards lose no link.  A shard above ``SHARD_ROWS`` is split by bands of its other
bits in the same way.  Each shard becomes a BK-tree whose children are keyed by
their Hamming distance to the parent, and every fingerprint follows only the
edges within the radius.  A shard's tree goes to the task that holds the shard's
queries: broadcasting all trees would carry a table that grows with the corpus
through the driver.  A subtree that already belongs to the component of the
query is skipped, so a dense group costs one link per member, not all pairs.

Edge cases: null and empty texts, and texts of white space, have fingerprint
zero and are linked like any other.  Equal texts share one fingerprint and enter
the search once.  The component of rows without any id is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearlex.llm.base import arrow_step, bound_batches, replaced
from nearlex.llm.components import components
from nearlex.session import stage

SEED = 42
#: Fingerprints in a shard before it is split by further bands.
SHARD_ROWS = 512
#: Levels of bands; after three, shards share at least 30 bits.
LEVELS = 3


def fingerprint(text: str, words: int = 4) -> int:
    """Majority bits of the shingle hashes of one text, as a signed 64-bit integer."""
    raw = text.encode("utf-8", "surrogatepass").lower().split()
    if not raw:
        return 0
    if len(raw) <= words:
        shingles = [b" ".join(raw)]
    else:
        line = b" ".join(raw)
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(length + 1) - 1
        starts = (ends - length)[: len(raw) - words + 1].tolist()
        shingles = [line[a:b] for a, b in zip(starts, ends[words - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 4, *others: str) -> DataFrame:
    """(doc_id, fp) of every row, with the bigint columns ``others`` between them."""
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(t or "", words) for t in batch.column("text").to_pylist()]
        return replaced(batch, "text", fp=pa.array(made, pa.int64()))

    schema = ", ".join([f"doc_id {kind}", *[f"{name} bigint" for name in others], "fp bigint"])
    return arrow_step(docs.select("doc_id", *others, "text"), schema, step)


class Tree:
    """BK-tree that links each new value to one member of every component in reach."""

    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []  # of the union-find forest
        self.uniform: list[int] = []  # a member of the only component below, or -1

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def add(self, value: int) -> list[int]:
        """Insert a value; the values it is linked to."""
        values, children, uniform = self.values, self.children, self.uniform
        new = len(values)
        self.parent.append(new)
        linked, stack = [], [0] if values else []
        while stack:
            i = stack.pop()
            if linked and uniform[i] >= 0 and self.find(uniform[i]) == self.find(new):
                continue
            d = (value ^ values[i]).bit_count()
            if d <= self.radius:
                root = self.find(i)
                if root != self.find(new):
                    self.parent[self.find(new)] = root
                    linked.append(values[i])
            low, high = d - self.radius, d + self.radius
            stack.extend([child for edge, child in children[i].items() if low <= edge <= high])
        values.append(value)
        children.append({})
        uniform.append(new)
        at = 0
        while at != new:
            if uniform[at] >= 0 and self.find(uniform[at]) != self.find(new):
                uniform[at] = -1
            at = children[at].setdefault((value ^ values[at]).bit_count(), new)
        return linked


def _bands(rest: Column, width: int, parts: int) -> tuple[list[tuple[Column, Column]], int]:
    """(value, other bits) of each of ``parts`` bands of the low ``width`` bits; width of the other bits."""
    out, low = [], 0
    for p in range(parts):
        size = width // parts + (p < width % parts)
        value = F.shiftrightunsigned(rest, low).bitwiseAND(F.lit((1 << size) - 1))
        above = F.shiftrightunsigned(rest, low + size) if low + size < 64 else F.lit(0).cast("long")
        other = F.shiftleft(above, low).bitwiseOR(rest.bitwiseAND(F.lit((1 << low) - 1)))
        out.append((value, other))
        low += size
    return out, width - width // parts


def _sharded(fps: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """(shard, fp): every pair within the radius meets in a shard."""
    rows = fps.select(F.lit(0).cast("long").alias("shard"), "fp", F.col("fp").alias("rest"))
    width, done = 64, None
    for level in range(LEVELS):
        bands, left = _bands(F.col("rest"), width, radius + 1)
        cells = F.array(
            *[
                F.struct(F.xxhash64("shard", F.lit(p), value).alias("shard"), other.alias("rest"))
                for p, (value, other) in enumerate(bands)
            ]
        )
        dealt = rows.select("fp", F.inline(cells))
        if level == LEVELS - 1:
            ready, rows = dealt, None
        else:
            # Hashing paths may merge two shards, which only adds candidates.
            full = stage(dealt.groupBy("shard").count().filter(F.col("count") > shard_rows).select("shard"), "full")
            ready = dealt.join(full, "shard", "left_anti")
            rows = None if full.isEmpty() else stage(dealt.join(full, "shard", "left_semi").select("shard", "fp", "rest"), "dealt")
        ready = ready.select("shard", "fp")
        done = ready if done is None else done.union(ready)
        if rows is None:
            break
        width = left
    return done


def links(fps: DataFrame, radius: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v): links within the radius that connect the distinct fingerprints ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, current = Tree(radius), None
        for batch in batches:
            u, v = [], []
            for shard, fp in zip(batch.column("shard").to_pylist(), batch.column("fp").to_pylist()):
                if shard != current:
                    tree, current = Tree(radius), shard
                for other in tree.add(fp & 0xFFFFFFFFFFFFFFFF):
                    u.append(fp)
                    v.append(other - (1 << 64) if other >> 63 else other)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    shards = _sharded(fps, radius, shard_rows)
    return shards.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(run, "u bigint, v bigint")


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """``nodes``, one row a fingerprint, with the smallest fingerprint of its component as root."""
    groups = stage(components(links(nodes.select("fp"), radius)), "groups")
    return nodes.join(groups, nodes["fp"] == groups["node"], "left").select(
        *[nodes[c] for c in nodes.columns], F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp and component_id (the smallest id reachable) of every row of ``docs``."""
    seen = stage(fingerprints(docs, words), "fingerprints")
    nodes = stage(seen.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    rooted = _rooted(nodes, radius)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    return seen.join(named, "fp").select("doc_id", "fp", "component_id")


def query(docs: DataFrame) -> DataFrame:
    """The fingerprint as 16 hexadecimal digits beside the component."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def survivors(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """One row of ``docs``, with all its columns, of every group of near-duplicates.

    The row with the smallest id stays, null after all others; of several rows with
    that id, one.  Groups are told apart by their root fingerprint and rows by two
    hashes of id and text, so neither null nor repeated ids join different groups.
    Rows of one id and text are reduced before they are shuffled.
    """
    # Two seeds make 128 bits; a null id is passed over by the hash.
    keys = {"_key": F.xxhash64("doc_id", "text"), "_key2": F.xxhash64(F.lit(1), "doc_id", "text")}
    keyed = docs.withColumns(keys)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", *keys)
    seen = fingerprints(keyed, words, *keys)
    nodes = stage(seen.groupBy("fp").agg(F.min(row).alias("row")), "nodes")
    keep = _rooted(nodes, radius).groupBy("root").agg(F.min("row").alias("row")).select(*[f"row.{k}" for k in keys])
    order = F.xxhash64(*[docs[c] for c, kind in docs.dtypes if "map<" not in kind])
    one = keyed.groupBy(*keys).agg(F.min_by(F.struct(*docs.columns), order).alias("_row"))
    return one.join(stage(keep, "keep"), list(keys), "left_semi").select("_row.*")
