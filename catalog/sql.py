"""Fragments of the comparison SQL (DuckDB dialect)."""

from __future__ import annotations

from nearlex.functions.stopwords import ENGLISH
from nearlex.functions.text import PUNCTUATION, WHITESPACE


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(quoted(w) for w in ENGLISH) + "]"
BY_LANGUAGE = "CAST(CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 WHEN 'es' THEN 4 END AS INTEGER)"
BY_ROLE = "CAST(CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 WHEN 'system' THEN 3 END AS INTEGER)"

DOCS = f"d AS (SELECT doc_id, {BY_LANGUAGE} AS label, text FROM documents)"
ASKED = "q AS (SELECT item_id AS doc_id, text FROM benchmark)"
TURN_ID = "(conv_id + turn) * (conv_id + turn + 1) // 2 + turn"
TURNS = f"d AS (SELECT {TURN_ID} AS doc_id, {BY_ROLE} AS label, text FROM conversations)"

STRIPPED = f"translate(lower(text), {quoted(PUNCTUATION)}, '')"
SPLIT = f"regexp_extract_all({STRIPPED}, '[^{WHITESPACE}]+')"
RAW_WORDS = (
    f"list_filter({SPLIT}, lambda t: NOT list_contains({STOP_LIST}, t) AND length(t) > 1)"
)
LETTERS = "regexp_extract_all(lower(text), '[a-z]+')"


def ngrams(words: str, order: int) -> str:
    """Unigrams up to n-grams of the list column ``words``."""
    out = words
    if order > 1:
        out += f" || list_transform(range(1, len({words})), lambda i: {words}[i] || '_' || {words}[i + 1])"
    if order > 2:
        out += (
            f" || list_transform(range(1, len({words}) - 1), lambda i:"
            f" {words}[i] || '_' || {words}[i + 1] || '_' || {words}[i + 2])"
        )
    return f"({out})"


def chars(words: str, n_min: int, n_max: int, pad: str, whole_short: bool = False) -> str:
    """Character n-grams of the padded words of a list expression."""
    padded = f"'{pad}' || w || '{pad}'"
    parts = []
    if whole_short:
        parts.append(f"(CASE WHEN length({padded}) < {n_min} THEN [{padded}] ELSE [] END)")
    for n in range(n_min, n_max + 1):
        parts.append(
            f"list_transform(range(1, length({padded}) - {n} + 2), lambda i: substr({padded}, i, {n}))"
        )
    return f"flatten(list_transform({words}, lambda w: {' || '.join(parts)}))"


def tokens(name: str, source: str, expression: str, order: int = 1, label: bool = True) -> str:
    """CTEs ending in ``name``: doc_id, label, toks."""
    lab = ", label" if label else ""
    return (
        f"{name}_w AS MATERIALIZED (SELECT doc_id{lab}, {expression} AS w FROM {source}), "
        f"{name} AS MATERIALIZED (SELECT doc_id{lab}, {ngrams('w', order)} AS toks FROM {name}_w)"
    )


def counts(name: str, toks: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM "
        f"(SELECT doc_id, unnest(toks) AS term FROM {toks}) GROUP BY doc_id, term)"
    )


def stats(toks: str, name: str = "st") -> str:
    return f"{name} AS MATERIALIZED (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM {toks})"


IDF = {
    "bm25": "ln((n - df + 0.5) / (df + 0.5) + 1)",
    "smooth": "ln((n + 1.0) / (df + 1.0)) + 1",
}


def vocab(
    tf: str, idf: str = "bm25", min_df: int = 2, cap: int | None = None,
    max_df: float | None = None, by: str = "df", name: str = "v", st: str = "st",
) -> str:
    upper = f" AND count(*) <= {max_df} * any_value(n)" if max_df is not None else ""
    limit = f" LIMIT {cap}" if cap is not None else ""
    return (
        f"{name} AS MATERIALIZED (SELECT term, df, total, {IDF[idf]} AS idf, "
        f"row_number() OVER (ORDER BY {by} DESC, term) - 1 AS term_id FROM ("
        f"SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total, any_value(n) AS n "
        f"FROM {tf}, {st} GROUP BY term HAVING count(*) >= {min_df}{upper}) "
        f"ORDER BY {by} DESC, term{limit})"
    )


WEIGHT = {
    "bm25": "idf * tf * ({k1} + 1) / (tf + {k1} * (1 - {b} + {b} * len(toks) / avgdl))",
    "sublinear": "(1 + ln(tf)) / len(toks) * idf",
    "tfidf": "tf * idf",
    "log_tfidf": "(1 + ln(tf)) * idf",
}


def weights(
    name: str, toks: str, tf: str, weight: str = "bm25", v: str = "v", k1: float = 1.2, b: float = 0.5,
    st: str = "st",
) -> str:
    """CTE ``name``: doc_id, term, w with unit rows."""
    formula = WEIGHT[weight].format(k1=k1, b=b)
    return (
        f"{name}_raw AS MATERIALIZED (SELECT doc_id, term, {formula} AS w FROM {tf} "
        f"JOIN {v} USING (term) JOIN {toks} USING (doc_id), {st}), "
        f"{name} AS MATERIALIZED ({unit(name + '_raw')})"
    )


def unit(rows: str, extra: str = "") -> str:
    """Select with unit rows, all-zero rows unchanged."""
    part = f"doc_id{extra}"
    return (
        f"SELECT {part}, term, w / (CASE WHEN sum(w * w) OVER (PARTITION BY {part}) = 0 THEN 1 "
        f"ELSE sqrt(sum(w * w) OVER (PARTITION BY {part})) END) AS w FROM {rows}"
    )


def chi2(name: str, w: str, docs: str) -> str:
    return (
        f"{name}_p AS (SELECT label, count(*) / (SELECT count(*) FROM {docs}) AS p FROM {docs} GROUP BY label), "
        f"{name}_o AS (SELECT term, label, sum(w) AS o FROM {w} JOIN {docs} USING (doc_id) GROUP BY term, label), "
        f"{name}_t AS (SELECT term, sum(o) AS total FROM {name}_o GROUP BY term), "
        f"{name} AS MATERIALIZED (SELECT t.term, sum((coalesce(o, 0) - p * total) ** 2 / (p * total)) AS chi2 "
        f"FROM {name}_t t CROSS JOIN {name}_p p LEFT JOIN {name}_o o ON o.term = t.term AND o.label = p.label "
        f"GROUP BY t.term)"
    )


def selected(name: str, w: str, scores: str, k: int) -> str:
    """CTE ``name``: rows of ``w`` on the ``k`` best terms, unit again."""
    return (
        f"{name}_top AS MATERIALIZED (SELECT term FROM {scores} ORDER BY round(chi2, 6) DESC, term LIMIT {k}), "
        f"{name}_raw AS (SELECT * FROM {w} SEMI JOIN {name}_top USING (term)), "
        f"{name} AS MATERIALIZED ({unit(name + '_raw')})"
    )


def dots(name: str, qw: str, tw: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT a.doc_id AS query_id, b.doc_id AS train_id, sum(a.w * b.w) AS dot "
        f"FROM {qw} a JOIN {tw} b USING (term) GROUP BY 1, 2)"
    )


def nearest(name: str, dot: str, docs: str, k: int, queries: str | None = None) -> str:
    """CTE ``name``: query_id, train_id, label, sim, rank; ``queries`` switches zero fill on."""
    if queries is None:
        rows = (
            f"SELECT query_id, train_id, label, round(dot, 6) AS sim FROM {dot} "
            f"JOIN {docs} d ON d.doc_id = train_id"
        )
    else:
        rows = (
            f"SELECT x.doc_id AS query_id, d.doc_id AS train_id, d.label, coalesce(round(dot, 6), 0) AS sim "
            f"FROM {queries} x CROSS JOIN {docs} d LEFT JOIN {dot} s "
            f"ON s.query_id = x.doc_id AND s.train_id = d.doc_id"
        )
    return (
        f"{name} AS MATERIALIZED (SELECT query_id, train_id, label, sim, CAST(rank AS INTEGER) AS rank FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, train_id) AS rank "
        f"FROM ({rows})) WHERE rank <= {k})"
    )


def decide(scores: str, queries: str, lowest: int = 1) -> str:
    """Select query_id, pred: highest score, ties to the lowest label, all queries kept."""
    return (
        f"SELECT x.doc_id AS query_id, CAST(coalesce(pred, {lowest}) AS INTEGER) AS pred FROM {queries} x LEFT JOIN ("
        f"SELECT query_id, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
        f"ORDER BY round(score, 9) DESC, label) AS r FROM {scores}) WHERE r = 1) p ON p.query_id = x.doc_id"
    )


def macro_f1(judged: str, by: str = "") -> str:
    """Select [by,] macro_f1 from rows of [by,] truth, pred."""
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {keys}avg(CASE WHEN tp + miss > 0 THEN 2.0 * tp / (2.0 * tp + miss) ELSE 0 END) AS macro_f1 FROM ("
        f"SELECT {keys}label, sum(tp) AS tp, sum(miss) AS miss FROM ("
        f"SELECT {keys}truth AS label, CAST(truth = pred AS INTEGER) AS tp, CAST(truth <> pred AS INTEGER) AS miss FROM {judged} "
        f"UNION ALL SELECT {keys}pred, 0, CAST(truth <> pred AS INTEGER) FROM {judged}) "
        f"GROUP BY {keys}label){group}"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def words(order: int = 1, expression: str = RAW_WORDS, docs: str = DOCS) -> tuple[str, ...]:
    """Documents, tokens, counts and statistics of the labelled corpus."""
    return docs, tokens("dt", "d", expression, order), counts("tf", "dt"), stats("dt")


def asked_words(order: int = 1, expression: str = RAW_WORDS) -> tuple[str, ...]:
    return ASKED, tokens("qt", "q", expression, order, label=False), counts("qf", "qt")


def word_vectors(weight: str = "bm25", order: int = 1, cap: int | None = None, **kw) -> tuple[str, ...]:
    """Everything up to unit rows of documents (``tw``) and questions (``qw``)."""
    idf = "bm25" if weight == "bm25" else "smooth"
    return (
        *words(order), *asked_words(order), vocab("tf", idf, cap=cap),
        weights("tw", "dt", "tf", weight, **kw), weights("qw", "qt", "qf", weight, **kw),
    )
