"""Text functions, Column in and Column out; counting and character n-grams are Arrow steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from nearlex.functions.batches import bag_batch, count_batch, gram_batch, ngram_batch

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Code points that count as whitespace between words.
WHITESPACE = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def letter_runs(text: Column) -> Column:
    """Lower-cased runs of ASCII letters."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), F.lit(1))


def strip_punctuation(text: Column) -> Column:
    """Lower-case and delete ASCII punctuation, leaving no gap behind."""
    return F.translate(F.lower(text), PUNCTUATION, "")


def split_words(text: Column) -> Column:
    """Split on Unicode whitespace; never yields an empty token."""
    return F.filter(F.split(text, f"[{WHITESPACE}]+"), lambda t: t != "")


def drop_short(tokens: Column, longer_than: int = 1) -> Column:
    return F.filter(tokens, lambda t: F.char_length(t) > longer_than)


def drop_words(tokens: Column, words: Sequence[str]) -> Column:
    """Remove every token found in ``words`` (a constant set, hashed once)."""
    listed = sorted(set(words))
    return F.filter(tokens, lambda t: ~t.isin(listed)) if listed else tokens


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def word_bigrams(tokens: Column) -> Column:
    """Adjacent pairs joined by ``_``; empty for fewer than two tokens."""

    def pairs(t: Column) -> Column:
        n = F.greatest(F.size(t) - 1, F.lit(0))
        return F.zip_with(F.slice(t, 1, n), F.slice(t, 2, n), lambda a, b: F.concat_ws("_", a, b))

    return let(tokens, pairs)


def word_trigrams(tokens: Column) -> Column:
    """Adjacent triples joined by ``_``; empty for fewer than three tokens."""

    def triples(t: Column) -> Column:
        n = F.greatest(F.size(t) - 2, F.lit(0))
        heads = F.zip_with(F.slice(t, 1, n), F.slice(t, 2, n), lambda a, b: F.concat_ws("_", a, b))
        return F.zip_with(heads, F.slice(t, 3, n), lambda ab, c: F.concat_ws("_", ab, c))

    return let(tokens, triples)


def with_ngrams(tokens: Column, max_order: int = 3) -> Column:
    """Unigrams, then bigrams, then trigrams, up to ``max_order``; a narrow Arrow step."""
    if max_order not in (1, 2, 3):
        raise ValueError("max_order must be 1, 2 or 3")

    if max_order == 1:
        return tokens

    def orders(lists: pa.Array) -> pa.Array:
        return ngram_batch(lists, max_order)

    return F.arrow_udf(orders, "array<string>")(tokens)


def ngram_order(token: Column) -> Column:
    """Order of a joined n-gram; ``_`` never occurs inside a stripped word."""
    return F.char_length(token) - F.char_length(F.replace(token, F.lit("_"), F.lit(""))) + 1


def keep_orders(tokens: Column, max_order: int) -> Column:
    return F.filter(tokens, lambda t: ngram_order(t) <= max_order)


def _grams(words: Column, n_min: int, n_max: int, pad: str, whole_short: bool) -> Column:
    def cut(lists: pa.Array) -> pa.Array:
        return gram_batch(lists, n_min, n_max, pad, whole_short)

    return F.arrow_udf(cut, "array<string>")(words)


def char_grams(text: Column, n_min: int = 3, n_max: int = 5) -> Column:
    """Character n-grams of ``_word_`` for each stripped word over one letter."""
    return _grams(drop_short(split_words(strip_punctuation(text))), n_min, n_max, "_", False)


def char_grams_in_word(text: Column, n_min: int = 3, n_max: int = 5) -> Column:
    """Character n-grams inside space-padded words, punctuation kept.

    A padded word shorter than ``n_min`` is emitted whole, once.
    """
    return _grams(split_words(F.lower(text)), n_min, n_max, " ", True)


def counted(tokens: Column) -> Column:
    """Term counts of one document: ``array<struct<term, tf>>``, terms sorted.

    A narrow Arrow step: counting needs no explode and no shuffle however large
    the corpus is.
    """
    return F.arrow_udf(count_batch, "array<struct<term:string,tf:bigint>>")(tokens)


def counted_with_length(tokens: Column) -> Column:
    """``struct<dl, terms>``: the number of tokens beside their counts.

    As the tokens are used once, Spark runs the Arrow steps that make them and
    this one in a single pass, so n-grams never leave the Python worker.
    """
    return F.arrow_udf(bag_batch, "struct<dl:int,terms:array<struct<term:string,tf:bigint>>>")(tokens)
