"""Text functions over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import data, porter_sql, sql
from catalog.registry import query
from nearlex.functions import porter, text as tx
from nearlex.operators import bags as bg
from nearlex.plans import presets as ps
from nearlex.session import spread



def _listing(df, tokens, hashed: bool = False):
    """doc_id, number of tokens, and the tokens (or their digest) as one string."""
    joined = tx.joined(F.col("t"))
    return spread(df, "doc_id").select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").cast("long").alias("n"),
        (F.md5(joined) if hashed else joined).alias("tokens"),
    )


def _list_sql(source: str, expression: str, hashed: bool = False) -> str:
    joined = "coalesce(array_to_string(t, ' '), '')"
    return sql.with_(source, f"x AS MATERIALIZED (SELECT doc_id, {expression} AS t FROM d)") + (
        f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n, {f'md5({joined})' if hashed else joined} AS tokens FROM x"
    )


@query(_list_sql(sql.DOCS, sql.LETTERS))
def t1_simple_tokens(spark, sf):
    return _listing(data.documents(spark, sf), tx.letter_runs(F.col("text")))


@query(sql.with_(sql.DOCS) + f"SELECT doc_id, {sql.STRIPPED} AS stripped FROM d")
def t2_strip_punctuation(spark, sf):
    docs = data.documents(spark, sf)
    return docs.select("doc_id", tx.strip_punctuation(F.col("text")).alias("stripped"))


@query(_list_sql(sql.DOCS, sql.SPLIT))
def t3_whitespace_split(spark, sf):
    return _listing(data.documents(spark, sf), tx.split_words(tx.strip_punctuation(F.col("text"))))


@query(_list_sql(sql.DOCS, f"list_filter({sql.SPLIT}, lambda t: length(t) > 1)"))
def t4_short_token_filter(spark, sf):
    words = tx.split_words(tx.strip_punctuation(F.col("text")))
    return _listing(data.documents(spark, sf), tx.drop_short(words))


@query(_list_sql(sql.DOCS, f"list_filter({sql.LETTERS}, lambda t: NOT list_contains({sql.STOP_LIST}, t))"))
def t5_stop_word_filter(spark, sf):
    return _listing(data.documents(spark, sf), bg.simple_analyzer()(F.col("text")))


_SUFFIXED = f"""words AS MATERIALIZED (SELECT DISTINCT unnest({sql.RAW_WORDS}) AS token FROM d),
lemmas AS MATERIALIZED (SELECT a.token, b.token AS lemma FROM words a JOIN words b ON a.token = b.token || 's')"""
LEMMA_TOKENS = (
    f"dt_p AS (SELECT doc_id, label, w[i] AS token, i FROM (SELECT doc_id, label, {sql.RAW_WORDS} AS w FROM d), "
    "unnest(range(1, len(w) + 1)) AS r(i)), "
    "dt_w AS MATERIALIZED (SELECT doc_id, label, coalesce(list(form ORDER BY i) FILTER (form IS NOT NULL), []) AS w FROM d LEFT JOIN "
    "(SELECT doc_id, i, coalesce(lemma, token) AS form FROM dt_p LEFT JOIN lemmas USING (token)) USING (doc_id) GROUP BY doc_id, label), "
    f"dt AS MATERIALIZED (SELECT doc_id, label, {sql.ngrams('w', 2)} AS toks FROM dt_w)"
)


def plural_lemmas(spark, sf):
    """Lemma table taken from the corpus: a word whose form without ``s`` also occurs."""
    words = data.raw_words(spark, sf).select(F.explode("tokens").alias("token")).distinct()
    singular = words.select(F.col("token").alias("lemma"), F.concat("token", F.lit("s")).alias("token"))
    return words.join(singular, "token").select("token", "lemma")


@query(sql.with_(sql.DOCS, _SUFFIXED, LEMMA_TOKENS)
       + "SELECT doc_id, CAST(len(w) AS BIGINT) AS n, coalesce(array_to_string(w, ' '), '') AS tokens FROM dt_w")
def t7_lemmatise(spark, sf):
    done = bg.normalised_by_table(data.raw_words(spark, sf), plural_lemmas(spark, sf))
    return _listing(done, F.col("tokens"))


@query(sql.with_(sql.DOCS) + f"SELECT doc_id, label, coalesce(array_to_string({sql.LETTERS}, ' '), '') AS joined FROM d")
def t8_joined_text(spark, sf):
    docs = data.documents(spark, sf)
    return docs.select("doc_id", "label", tx.joined(tx.letter_runs(F.col("text"))).alias("joined"))


def _pair_sql(expression: str) -> str:
    return sql.with_(sql.DOCS, f"w AS MATERIALIZED (SELECT doc_id, {sql.RAW_WORDS} AS w FROM d)",
                     f"x AS MATERIALIZED (SELECT doc_id, {expression} AS t FROM w)") + (
        "SELECT doc_id, CAST(len(t) AS BIGINT) AS n, coalesce(array_to_string(t, ' '), '') AS tokens FROM x")


@query(_pair_sql("list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])"))
def t9_word_bigrams(spark, sf):
    return _listing(data.raw_words(spark, sf), tx.word_bigrams(F.col("tokens")))


@query(_pair_sql("list_transform(range(1, len(w) - 1), lambda i: w[i] || '_' || w[i + 1] || '_' || w[i + 2])"))
def t10_word_trigrams(spark, sf):
    return _listing(data.raw_words(spark, sf), tx.word_trigrams(F.col("tokens")))


@query(_pair_sql(sql.ngrams("w", 2)))
def t12_raw_word_stream(spark, sf):
    return _listing(data.documents(spark, sf), bg.rich_analyzer(2, normaliser=None)(F.col("text")))


@query(_pair_sql(f"list_filter({sql.ngrams('w', 3)}, lambda t: length(t) - length(replace(t, '_', '')) <= 1)"))
def t13_ngram_order_filter(spark, sf):
    return _listing(data.raw_words(spark, sf), tx.keep_orders(tx.with_ngrams(F.col("tokens"), 3), 2))


LONG_WORDS = f"list_filter({sql.SPLIT}, lambda t: length(t) > 1)"


@query(sql.with_(sql.DOCS, f"w AS MATERIALIZED (SELECT doc_id, {LONG_WORDS} AS ws FROM d)",
                 f"x AS MATERIALIZED (SELECT doc_id, {sql.chars('ws', 3, 5, '_')} AS t FROM w)")
       + "SELECT doc_id, CAST(len(t) AS BIGINT) AS n, md5(coalesce(array_to_string(t, ' '), '')) AS tokens FROM x")
def t14_char_grams(spark, sf):
    docs = data.documents(spark, sf)
    return _listing(bg.tokenised(docs, tx.char_grams), F.col("tokens"), hashed=True)


KEPT_WORDS = f"regexp_extract_all(lower(text), '[^{sql.WHITESPACE}]+')"


@query(sql.with_(sql.DOCS, f"w AS MATERIALIZED (SELECT doc_id, {KEPT_WORDS} AS ws FROM d)",
                 f"x AS MATERIALIZED (SELECT doc_id, {sql.chars('ws', 3, 5, ' ', True)} AS t FROM w)")
       + "SELECT doc_id, CAST(len(t) AS BIGINT) AS n, md5(coalesce(array_to_string(t, ' '), '')) AS tokens FROM x")
def t15_char_grams_in_word(spark, sf):
    docs = data.documents(spark, sf)
    return _listing(bg.tokenised(docs, tx.char_grams_in_word), F.col("tokens"), hashed=True)


DISTINCT_WORDS = f"words AS MATERIALIZED (SELECT DISTINCT token FROM (SELECT unnest({sql.RAW_WORDS}) AS token FROM d))"


@query(sql.with_(sql.DOCS, DISTINCT_WORDS, porter_sql.stems()) + "SELECT token, stem FROM stems")
def t6_stem_dictionary(spark, sf):
    words = data.raw_words(spark, sf).select(F.explode("tokens").alias("token")).distinct()
    return words.select("token", porter.stem(F.array("token"))[0].alias("stem"))


def stemmed_tokens(name: str, source: str, order: int, label: bool = True) -> str:
    """CTEs ending in ``name``: stemmed n-grams of ``source``, given ``stems``."""
    lab = ", label" if label else ""
    return (
        f"{name}_p AS (SELECT doc_id, w[i] AS token, i FROM (SELECT doc_id, {sql.RAW_WORDS} AS w FROM {source}), unnest(range(1, len(w) + 1)) AS r(i)), "
        f"{name}_w AS MATERIALIZED (SELECT doc_id{lab}, coalesce(list(stem ORDER BY i) FILTER (stem IS NOT NULL), []) AS w FROM {source} "
        f"LEFT JOIN (SELECT doc_id, i, stem FROM {name}_p JOIN stems USING (token)) USING (doc_id) GROUP BY doc_id{lab}), "
        f"{name} AS MATERIALIZED (SELECT doc_id{lab}, {sql.ngrams('w', order)} AS toks FROM {name}_w)"
    )


@query(sql.with_(sql.DOCS, DISTINCT_WORDS, porter_sql.stems(), stemmed_tokens("dt", "d", 3))
       + "SELECT doc_id, CAST(len(toks) AS BIGINT) AS n, md5(coalesce(array_to_string(toks, ' '), '')) AS tokens FROM dt")
def t11_rich_token_stream(spark, sf):
    return _listing(bg.tokenised(data.documents(spark, sf), bg.rich_analyzer(3)), F.col("tokens"), hashed=True)
