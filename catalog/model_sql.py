"""Comparison SQL of the named configurations: from texts to class scores."""

from __future__ import annotations

from catalog import porter_sql, sql
from catalog.text_queries import LONG_WORDS, _SUFFIXED as SUFFIXED, stemmed_tokens
from nearlex.plans import presets as ps

K = 11


def _scored_sql(power: float = 1.0, digits: int | None = 6) -> tuple[str, str]:
    weight = "sim" if power == 1.0 else f"pow(greatest(sim, 0), {power})"
    total = f"sum({weight})" if digits is None else f"round(sum({weight}), {digits})"
    return (
        sql.nearest("nn", "s", "d", K),
        f"SELECT query_id, label, {total} AS score FROM nn GROUP BY query_id, label",
    )


def scores_sql(spec: ps.Representation, *token_ctes: str, power: float = 1.0, digits: int | None = 6) -> str:
    """From ``dt`` and ``qt`` to class scores."""
    idf = "bm25" if spec.weight == "bm25" else "smooth"
    kw = {"k1": spec.k1, "b": spec.b}
    parts = [
        *token_ctes, sql.counts("tf", "dt"), sql.stats("dt"), sql.counts("qf", "qt"),
        sql.vocab("tf", idf, spec.min_df, spec.max_terms, spec.max_df, spec.cap_by),
        sql.weights("tw", "dt", "tf", spec.weight, **kw), sql.weights("qw", "qt", "qf", spec.weight, **kw),
    ]
    train, asked = "tw", "qw"
    if spec.chi2:
        parts += [
            sql.chi2("c", "tw", "d"), sql.selected("ts", "tw", "c", spec.chi2),
            f"qs_raw AS (SELECT * FROM qw SEMI JOIN ts_top USING (term)), qs AS MATERIALIZED ({sql.unit('qs_raw')})",
        ]
        train, asked = "ts", "qs"
    near, final = _scored_sql(power, digits)
    return sql.with_(*parts, sql.dots("s", asked, train), near) + final


ALL_WORDS = (
    f"words AS MATERIALIZED (SELECT DISTINCT unnest({sql.RAW_WORDS}) AS token FROM "
    "(SELECT text FROM d UNION ALL SELECT text FROM q))"
)


def stemmed(order: int) -> tuple[str, ...]:
    return (
        sql.DOCS, sql.ASKED, ALL_WORDS, porter_sql.stems(),
        stemmed_tokens("dt", "d", order), stemmed_tokens("qt", "q", order, label=False),
    )


def lemma_tokens(name: str, source: str, label: bool, words: str = sql.RAW_WORDS, order: int = 2) -> str:
    lab = ", label" if label else ""
    return (
        f"{name}_p AS (SELECT doc_id, w[i] AS token, i FROM (SELECT doc_id, {words} AS w FROM {source}), unnest(range(1, len(w) + 1)) AS r(i)), "
        f"{name}_w AS MATERIALIZED (SELECT doc_id{lab}, coalesce(list(form ORDER BY i) FILTER (form IS NOT NULL), []) AS w FROM {source} LEFT JOIN "
        f"(SELECT doc_id, i, coalesce(lemma, token) AS form FROM {name}_p LEFT JOIN lemmas USING (token)) USING (doc_id) GROUP BY doc_id{lab}), "
        f"{name} AS MATERIALIZED (SELECT doc_id{lab}, {sql.ngrams('w', order)} AS toks FROM {name}_w)"
    )


LEMMAS = (sql.DOCS, sql.ASKED, SUFFIXED, lemma_tokens("dt", "d", True), lemma_tokens("qt", "q", False))
RAW = (
    sql.DOCS, sql.ASKED, sql.tokens("dt", "d", sql.RAW_WORDS, 2),
    sql.tokens("qt", "q", sql.RAW_WORDS, 2, label=False),
)


def _char(pad: str, words: str, whole: bool) -> tuple[str, ...]:
    grams = sql.chars("ws", 3, 5, pad, whole)
    return (
        sql.DOCS, sql.ASKED,
        f"dw AS (SELECT doc_id, label, {words} AS ws FROM d)", f"qw0 AS (SELECT doc_id, {words} AS ws FROM q)",
        f"dt AS MATERIALIZED (SELECT doc_id, label, {grams} AS toks FROM dw)",
        f"qt AS MATERIALIZED (SELECT doc_id, {grams} AS toks FROM qw0)",
    )


CHARS = _char("_", LONG_WORDS, False)
CHARS_WB = _char(" ", f"regexp_extract_all(lower(text), '[^{sql.WHITESPACE}]+')", True)
