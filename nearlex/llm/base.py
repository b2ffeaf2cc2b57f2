"""What the operators of this package share: reading, seeded remainders, Arrow steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearlex.session import ship_package

#: Bytes of one Arrow batch between the JVM and Python, so that long texts cannot fill a worker.
BATCH_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the package is shipped to the workers once per session."""
    ship_package(spark)
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % divisor, F.lit(-1))


def arrow_step(
    df: DataFrame, schema: str, step: Callable[[pa.RecordBatch], pa.RecordBatch]
) -> DataFrame:
    """Apply ``step`` to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield step(batch)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def replaced(batch: pa.RecordBatch, drop: str, **columns: pa.Array) -> pa.RecordBatch:
    """The batch without ``drop`` and with ``columns`` behind."""
    names = [n for n in batch.schema.names if n != drop]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in names] + list(columns.values()), names=names + list(columns)
    )
