"""Session helpers: durable stages, size-checked broadcasts, input spreading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table (estimated bytes in memory) that may be broadcast by a hint.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

#: Rows of an Arrow batch, and of a batch of a Parquet reader, which holds every element of its rows.
BATCH_ROWS = 1_000
READ_ROWS = 512

#: Spark's setting to delete shuffle files at the end of a job.
RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_RUN = uuid.uuid4().hex[:12]


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Where it is unset (local tests) a temporary folder is used; a cluster
    session without the setting is refused, because a machine-local folder
    would not survive the loss of an executor.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    configured = configured or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="nearlex-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def release_shuffles(spark: SparkSession) -> None:
    """Delete the shuffle files of each job when it has ended; what comes after reads stages.

    Otherwise they stay until the driver happens to collect its garbage, so the
    disk would hold all steps of a query at once.  A table that is run again
    without being staged is computed again.
    """
    if spark.conf.get(RELEASED, "false") != "true":
        spark.conf.set(RELEASED, "true")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts lineage (a stage is never recomputed after an executor is lost), gives
    Catalyst real file sizes, and keeps column pruning for every later reader.
    Zstandard makes the terms of bags, the largest stage, smaller than the default codec.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/nearlex-{_RUN}/{name}-{uuid.uuid4().hex[:10]}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._nearlex_path = path
    return out


def remove_stage(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    _delete(df.sparkSession, df._nearlex_path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def remove_stages(spark: SparkSession) -> None:
    """Delete every table this run has staged; results that still read them become invalid."""
    _delete(spark, f"{checkpoint_root(spark)}/nearlex-{_RUN}")


def measured_bytes(df: DataFrame) -> int:
    """Estimated in-memory size of a (staged) table from its own rows."""
    size: Column = F.lit(16)
    for name, kind in df.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + 16
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(name)))), F.lit(0))
        else:
            size = size + 8
    return int(df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0).cast("long"))).first()[0])


def broadcast_if_small(
    df: DataFrame, *columns: str, limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Chosen ``columns`` with a broadcast hint only if ``df`` measures under ``limit``.

    Beyond it the table is returned without a hint, so the join runs as a
    shuffle join, with AQE splitting skewed partitions.  The size is measured
    once per table.
    """
    size = getattr(df, "_nearlex_bytes", None)
    if size is None:
        size = measured_bytes(df)
        df._nearlex_bytes = size
    out = df.select(*columns) if columns else df
    return F.broadcast(out) if size <= limit else out


def sent_if_small(df: DataFrame, *columns: str, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame | None:
    """Chosen ``columns`` with a broadcast hint if ``df`` measures under ``limit``, else ``None``."""
    size = getattr(df, "_nearlex_bytes", None)
    if size is None:
        size = measured_bytes(df)
        df._nearlex_bytes = size
    return F.broadcast(df.select(*columns) if columns else df) if size <= limit else None


def collected_if_small(df: DataFrame, *columns: str, limit: int = BROADCAST_LIMIT_BYTES):
    """Chosen ``columns`` as an Arrow table if ``df`` measures under ``limit``, else ``None``."""
    size = getattr(df, "_nearlex_bytes", None)
    if size is None:
        size = measured_bytes(df)
        df._nearlex_bytes = size
    return df.select(*columns).toArrow() if size <= limit else None


def bound_batches(spark: SparkSession) -> None:
    """Keep batches small enough for rows that grow on the way (n-grams of long texts) and for rows of long arrays."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) > READ_ROWS:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, 1)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle the raw input only if its scan has fewer splits than task slots.

    Large inputs already have plenty of splits and pass through untouched; one
    unsplittable file would otherwise tokenise in a single task.
    """
    slots = parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *keys)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever the driver runs."""
    import pathlib
    import shutil

    release_shuffles(spark)
    context = spark.sparkContext
    if getattr(context, "_nearlex_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="nearlex-code-")) / "nearlex"
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._nearlex_shipped = True
