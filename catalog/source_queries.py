"""Text files written by Spark from the given tables and read back as sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import data, sql
from catalog.registry import query
from nearlex.operators.ranking import head
from nearlex.session import checkpoint_root
from nearlex.sources import lines, predictions


def _one_line(column):
    return F.regexp_replace(column, "[\\n\\r]+", " ")


_FLAT = "regexp_replace(text, '[\\n\\r]+', ' ', 'g')"


def _folder(spark) -> str:
    return f"{checkpoint_root(spark)}/lines-{uuid.uuid4().hex[:10]}"


def _written(spark, ordered):
    """Write one ``value`` per line in the order of ``doc_id``; returns the folder."""
    path = _folder(spark)
    ordered.orderBy("doc_id").select("value").write.text(path)
    return path


@data.shared
def labelled_file(spark, sf):
    docs = data.documents(spark, sf)
    line = F.concat_ws(" ", F.col("label").cast("string"), _one_line(F.col("text")))
    return _written(spark, docs.select("doc_id", line.alias("value")))


@data.shared
def turn_file(spark, sf):
    """Lines ``turn text``: turns outside 1..4 are not labelled lines."""
    turns = data.table(spark, sf, "conversations")
    line = F.concat_ws(" ", F.col("turn").cast("string"), _one_line(F.col("text")))
    return _written(
        spark, turns.select(data.turn_id(), line.alias("value"))
    )


@data.shared
def raw_file(spark, sf):
    """Whole document texts, inner line ends kept."""
    docs = data.documents(spark, sf)
    return _written(spark, docs.select("doc_id", F.col("text").alias("value")))


_TURN_LINES = (
    f"l AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {sql.TURN_ID}) - 1 AS line_id, "
    f"turn || ' ' || {_FLAT} AS value FROM conversations)"
)
_RAW_LINES = (
    "p AS (SELECT doc_id, string_split_regex(text, '\\r\\n|\\n|\\r') AS parts FROM documents), "
    "l AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS line_id, parts[i] AS value FROM p, unnest(range(1, len(parts) + 1)) AS r(i))"
)
_WS = sql.WHITESPACE


def _renumbered_sql(rows: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY line_id) - 1 AS doc_id, * EXCLUDE (line_id) FROM ({rows})"


@query(sql.with_(sql.DOCS, f"x AS (SELECT doc_id AS line_id, label, regexp_replace({_FLAT}, '^[{_WS}]+', '') AS text FROM d)")
       + _renumbered_sql("SELECT * FROM x"))
def s1_labelled_scan(spark, sf):
    return lines.read_labelled(spark, labelled_file(spark, sf))


@query(sql.with_(_TURN_LINES) + f"SELECT line_id AS doc_id, substr(value, 1, 80) AS line FROM l WHERE value <> '' AND NOT regexp_matches(value, '^[1-4][{_WS}]')")
def s2_malformed_lines(spark, sf):
    found = lines.bad_lines(lines.with_line_ids(spark.read.text(turn_file(spark, sf))))
    return found.select("doc_id", F.substring("value", 1, 80).alias("line"))


_TRIM = f"regexp_replace(value, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


@query(sql.with_(_TURN_LINES, f"t AS (SELECT line_id, {_TRIM} AS v FROM l)") + _renumbered_sql(
    "SELECT line_id, CAST(split_part(v, ' ', 1) AS INTEGER) AS label, "
    "CASE WHEN strpos(v, ' ') = 0 THEN '' ELSE substr(v, strpos(v, ' ') + 1) END AS text FROM t WHERE v <> ''"))
def s3_lenient_scan(spark, sf):
    return lines.read_labelled(spark, turn_file(spark, sf), strict=False)


@query(sql.with_(_RAW_LINES) + "SELECT line_id AS doc_id, value AS text FROM l")
def s4_unlabelled_keep_blank(spark, sf):
    return lines.read_unlabelled(spark, raw_file(spark, sf))


@query(sql.with_(_RAW_LINES, f"t AS (SELECT line_id, {_TRIM} AS text FROM l)") + _renumbered_sql("SELECT * FROM t WHERE text <> ''"))
def s5_unlabelled_drop_blank(spark, sf):
    return lines.read_unlabelled(spark, raw_file(spark, sf), keep_blank=False)


@query("SELECT doc_id, md5(text || chr(65533)) AS digest FROM documents")
def s6_invalid_utf8(spark, sf):
    """A stray 0xFF byte after every text."""
    broken = F.concat(F.col("text").cast("binary"), F.lit(b"\xff")).cast("string")
    docs = data.documents(spark, sf)
    return docs.select("doc_id", F.md5(lines.valid_text(broken)).alias("digest"))


@query(sql.with_(sql.TURNS) + "SELECT doc_id, label, text FROM d ORDER BY doc_id LIMIT 200")
def s7_head_limit(spark, sf):
    return head(data.turns(spark, sf), 200, "doc_id")


@query(sql.with_(_RAW_LINES) + "SELECT line_id AS doc_id, CAST(length(value) AS INTEGER) AS n_chars FROM l")
def s8_positional_ids(spark, sf):
    numbered = lines.with_line_ids(spark.read.text(raw_file(spark, sf)))
    return numbered.select("doc_id", F.char_length("value").alias("n_chars"))


@query(sql.with_(sql.DOCS) + "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, CAST(label AS VARCHAR) AS text FROM d")
def s9_prediction_sink(spark, sf):
    """Labels written as prediction lines, read back by position."""
    path = _folder(spark)
    docs = data.documents(spark, sf).select("doc_id", F.col("label").alias("pred"))
    predictions.write_lines(docs, path)
    return lines.read_unlabelled(spark, path)


@query("""SELECT count(l.doc_id) AS n_predicted, count(d.doc_id) AS n_expected,
count(*) FILTER (d.doc_id IS NULL) AS unexpected, count(*) FILTER (l.doc_id IS NULL) AS missing
FROM (SELECT DISTINCT doc_id FROM labels) l FULL JOIN (SELECT DISTINCT doc_id FROM documents) d ON d.doc_id = l.doc_id""")
def s10_output_reconciliation(spark, sf):
    have = data.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("pred"))
    return predictions.reconcile(have, data.documents(spark, sf))


@query(sql.with_(sql.DOCS) + "SELECT label, count(*) AS n FROM d GROUP BY label")
def s11_corpus_profile(spark, sf):
    return predictions.label_histogram(data.documents(spark, sf))
