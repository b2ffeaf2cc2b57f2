"""Text-file sources: one document per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearlex.functions.text import WHITESPACE
from nearlex.session import broadcast_if_small, stage

# A class digit, whitespace, then the text.
LABELLED_LINE = rf"(?s)^([1-4])[{WHITESPACE}]+(.*)$"


_PLACE = ("_file", "_start")


def _placed(lines: DataFrame) -> DataFrame:
    """Lines of text files beside the split they come from."""
    return lines.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    )


def with_line_ids(lines: DataFrame) -> DataFrame:
    """Add the 0-based line number of text files, read in path and offset order.

    Rows of ``_placed`` already parsed and filtered get consecutive numbers of their own.  Each
    split numbers its rows and the splits' sizes (one row each) give the
    offsets, so no line is sorted or passes through a single task.
    """
    from pyspark.sql import Window

    if _PLACE[0] not in lines.columns:
        lines = _placed(lines)
    placed = stage(lines.withColumn("_place", F.monotonically_increasing_id()), "lines")
    order = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = placed.groupBy("_file", "_start").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    offsets = splits.select(
        "_file", "_start", "_first", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_offset")
    )
    # One row per split: normally broadcast, so the text itself is not shuffled.
    joined = placed.join(broadcast_if_small(stage(offsets, "offsets")), ["_file", "_start"])
    doc_id = (F.col("_offset") + F.col("_place") - F.col("_first")).cast("long")
    return joined.select(doc_id.alias("doc_id"), *[c for c in lines.columns if c not in _PLACE])


def valid_text(value: Column) -> Column:
    """Invalid UTF-8 bytes become the replacement character."""
    return F.make_valid_utf8(value)


def is_labelled(value: Column) -> Column:
    return value.rlike(LABELLED_LINE)


def parse_labelled(lines: DataFrame, value: str = "value") -> DataFrame:
    """``label, text`` of labelled lines; a bad line raises with its first 80 characters."""
    keep = [c for c in lines.columns if c != value]
    line = F.col(value)
    message = F.concat(F.lit("Bad labelled line: "), F.substring(line, 1, 80))
    checked = F.when(is_labelled(line), line).otherwise(F.raise_error(message))
    return (
        lines.filter(line != "")
        .select(*keep, checked.alias("_line"))
        .select(
            *keep,
            F.regexp_extract("_line", LABELLED_LINE, 1).cast("int").alias("label"),
            F.regexp_extract("_line", LABELLED_LINE, 2).alias("text"),
        )
    )


def bad_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Non-empty lines that are not labelled lines, for quarantine."""
    return lines.filter((F.col(value) != "") & ~is_labelled(F.col(value)))


def parse_lenient(lines: DataFrame, value: str = "value") -> DataFrame:
    """Trim, split at the first space, any integer label; missing text is empty."""
    keep = [c for c in lines.columns if c != value]
    parts = F.split(trimmed(F.col(value)), " ", 2)
    return lines.filter(trimmed(F.col(value)) != "").select(
        *keep,
        parts[0].cast("int").alias("label"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("text"),
    )


def trimmed(value: Column) -> Column:
    return F.regexp_replace(value, f"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def drop_blank(lines: DataFrame, value: str = "value") -> DataFrame:
    """Trim lines and drop blank ones."""
    return lines.withColumn(value, trimmed(F.col(value))).filter(F.col(value) != "")


def read_labelled(
    spark: SparkSession, path: str, *, strict: bool = True, replace_invalid: bool = True,
    max_rows: int | None = None,
) -> DataFrame:
    """``doc_id, label, text`` of a labelled file; ``doc_id`` counts documents."""
    lines = _placed(spark.read.text(path))
    if replace_invalid:
        lines = lines.withColumn("value", valid_text(F.col("value")))
    docs = with_line_ids(parse_labelled(lines) if strict else parse_lenient(lines))
    return docs.filter(F.col("doc_id") < max_rows) if max_rows is not None else docs


def read_unlabelled(
    spark: SparkSession, path: str, *, keep_blank: bool = True, replace_invalid: bool = True
) -> DataFrame:
    """``doc_id, text``; dropping blank lines renumbers the rest."""
    lines = _placed(spark.read.text(path))
    if replace_invalid:
        lines = lines.withColumn("value", valid_text(F.col("value")))
    if not keep_blank:
        lines = drop_blank(lines)
    return with_line_ids(lines).withColumnRenamed("value", "text")
