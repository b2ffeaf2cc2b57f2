"""Look up the elements of an array column in a table that is too large for a task.

``in_blocks`` packs rows into blocks that ask for each of their distinct keys once,
so what is joined is a fraction of the elements, and no row is taken apart.
``matched`` joins every element.  Rows are told apart by their place in the input,
not by an id, so null and repeated ids give the same rows as a lookup inside the row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearlex.session import bound_batches, stage

#: Elements of one key that meet in a task, and keys with more of them that are told to all tasks.
KEY_ROWS = 100_000
MOST_HEAVY = 50_000
#: Elements of a block of rows, and of one binary value of it.
BLOCK_ELEMENTS = 2_000_000
PIECE_ELEMENTS = 250_000


def heavy_keys(keys: DataFrame, key_rows: int | None = None) -> DataFrame:
    """(_key, _parts): keys with very many rows, and over how many parts to deal them.

    A key is heavy above ``KEY_ROWS`` rows or a 50,000th of all rows, whichever
    is more, so there are never more than ``MOST_HEAVY`` of them.
    """
    counted = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    total = keys.count()
    limit = max(KEY_ROWS if key_rows is None else key_rows, total // MOST_HEAVY)
    return counted.filter(F.col("_rows") > limit).select("_key", F.ceil(F.col("_rows") / limit).cast("int").alias("_parts"))


def matched(
    rows: DataFrame, items: str, key: Callable[[Column], Column], table: DataFrame, on: str,
    key_rows: int | None = None,
) -> DataFrame:
    """``rows`` with ``items`` replaced by ``hits``: the elements in order, each beside its row of ``table``.

    ``hits`` is ``array<struct<_pos, _item, _hit>>`` with a null ``_hit`` where
    ``table`` has no row; ``on`` must be unique in it.  Elements of a heavy key
    are dealt over parts and its row of ``table`` is repeated for each.
    """
    keep = [c for c in rows.columns if c != items]
    heavy = F.broadcast(heavy_keys(rows.select(F.explode(items).alias("_item")).select(key(F.col("_item")).alias("_key")), key_rows))
    parts = F.coalesce("_parts", F.lit(1))
    long = (
        # Numbered before elements become rows.
        rows.select(F.monotonically_increasing_id().alias("_row"), F.struct(*keep).alias("_keep"), items)
        .select("_row", "_keep", F.posexplode_outer(items).alias("_pos", "_item"))
        .withColumn("_key", key(F.col("_item")))
        .join(heavy, "_key", "left")
        .withColumn("_part", F.pmod(F.xxhash64("_row", "_pos"), parts).cast("int"))
        .drop("_parts")
    )
    known = (
        table.select(F.col(on).alias("_key"), F.struct(*table.columns).alias("_hit"))
        .join(heavy, "_key", "left")
        .select("_key", "_hit", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    )
    entry = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_item", "_hit"))
    return (
        long.join(known, ["_key", "_part"], "left")
        .groupBy("_row")
        .agg(F.first("_keep").alias("_keep"), F.collect_list(entry).alias("hits"))
        .select("_keep.*", F.array_sort("hits", lambda a, b: a["_pos"] - b["_pos"]).alias("hits"))
    )


def _coded(batch: pa.RecordBatch, keep: list[str], items: str, field: str, codes: pa.Array) -> bytes:
    """A part of a block as a compressed Arrow stream, with the key of each element replaced by the step to its code."""
    lists = batch.column(items)
    flat = pc.list_flatten(lists)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rest = [flat.type.field(i).name for i in range(flat.type.num_fields) if flat.type.field(i).name != field]
    # Codes ascend where the elements of a row are sorted, so their steps are small numbers.
    steps = pa.array(np.diff(codes.to_numpy(zero_copy_only=False), prepend=0).astype(np.int32))
    coded = pa.StructArray.from_arrays([steps, *[pc.struct_field(flat, n) for n in rest]], names=["_step", *rest])
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    out = pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.ListArray.from_arrays(ends, coded)], names=[*keep, "_items"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, out.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(out)
    return sink.getvalue().to_pybytes()


def in_blocks(rows: DataFrame, items: str, field: str, table: DataFrame, out: list[str]) -> DataFrame:
    """``rows`` with ``items`` replaced by ``found``: its elements that ``table`` has, in order.

    ``items`` is an array of structs with a key ``field``, unique in ``table``;
    ``out`` names the fields of a found element, of the row of ``table`` if it has
    them, else of the element.  Rows are packed into blocks of bounded elements;
    a block asks for each distinct key once and is met by the answers in one task.
    """
    bound_batches(rows.sparkSession)
    keep = [c for c in rows.columns if c != items]
    held = {f.name: f.dataType for f in rows.schema[items].dataType.elementType.fields}
    given = {f.name: f.dataType for f in table.schema.fields}
    most, piece = BLOCK_ELEMENTS, PIECE_ELEMENTS

    def packed(part: int, batches: list[pa.RecordBatch], sizes: list[int]):
        keys = pa.chunked_array([pc.struct_field(pc.list_flatten(b.column(items)), field) for b in batches]).combine_chunks()
        keys = pa.concat_arrays(keys.chunks) if isinstance(keys, pa.ChunkedArray) else keys
        coded = keys.dictionary_encode()
        n, order = len(coded.dictionary), pc.sort_indices(coded.dictionary)
        place = np.empty(n, np.int32)
        place[np.asarray(order)] = np.arange(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part), pa.int64()), pa.array(np.arange(n), pa.int32()), coded.dictionary.take(order), pa.nulls(n, pa.binary())],
            names=["part", "pos", "key", "data"],
        )
        codes, start = pc.fill_null(pa.array(place, pa.int32()).take(coded.indices), -1), 0
        for batch, size in zip(batches, sizes):
            data = _coded(batch, keep, items, field, codes.slice(start, size))
            start += size
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, keys.type), pa.array([data], pa.binary())],
                names=["part", "pos", "key", "data"],
            )

    def pack(batches):
        from pyspark import TaskContext

        part, waiting, sizes = TaskContext.get().partitionId() << 32, [], []
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(items)), 0).to_numpy(zero_copy_only=False))
            start = before = 0
            while start < batch.num_rows:
                stop = max(int(np.searchsorted(ends, before + piece, "right")), start + 1)
                waiting.append(batch.slice(start, stop - start))
                sizes.append(int(ends[stop - 1]) - before)
                start, before = stop, int(ends[stop - 1])
                if sum(sizes) >= most:
                    yield from packed(part, waiting, sizes)
                    part, waiting, sizes = part + 1, [], []
        if waiting:
            yield from packed(part, waiting, sizes)

    def met(answers: pa.Table, block: pa.Table) -> pa.Table:
        at_key = np.full((pc.max(answers.column("pos")).as_py() if answers.num_rows else -1) + 1, -1)
        at_key[answers.column("pos").to_numpy()] = np.arange(answers.num_rows)
        made = []
        for data in block.column("data"):
            batch = pa.ipc.open_stream(data.as_buffer()).read_all().combine_chunks().to_batches()[0]
            lists = batch.column("_items")
            flat = pc.list_flatten(lists)
            codes = np.cumsum(pc.struct_field(flat, "_step").to_numpy(zero_copy_only=False))
            asked = (codes >= 0) & (codes < len(at_key))
            at = np.full(len(codes), -1)
            at[asked] = at_key[codes[asked]]
            real = at >= 0
            ends = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            kept, at = flat.filter(pa.array(real)), pa.array(at[real], pa.int64())
            values = [
                answers.column(n).take(at).combine_chunks() if n in given else pc.struct_field(kept, n) for n in out
            ]
            values = [pa.concat_arrays(v.chunks) if isinstance(v, pa.ChunkedArray) else v for v in values]
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, names=out))
            made.append(pa.table([*[batch.column(c) for c in keep], found], names=[*keep, "found"]))
        return pa.concat_tables(made) if made else nothing

    entry = T.StructType([T.StructField(n, given.get(n, held.get(n))) for n in out])
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("found", T.ArrayType(entry))])
    from pyspark.sql.pandas.types import to_arrow_schema

    nothing = to_arrow_schema(schema).empty_table()
    kind = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("key", held[field]),
        T.StructField("data", T.BinaryType()),
    ])
    blocks = stage(rows.select(*keep, items).mapInArrow(pack, kind), "blocks")
    answers = (
        blocks.filter("key is not null").select("part", "pos", "key")
        .join(table.withColumn("key", F.col(field)), "key")
        .select(F.col("part").alias("part"), "pos", *[F.col(n).alias(n) for n in out if n in given])
    )
    data = blocks.filter("data is not null").select(F.col("part").alias("part"), F.col("data").alias("data"))
    return answers.groupBy("part").cogroup(data.groupBy("part")).applyInArrow(met, schema)
