"""Language identification by words first, with backing off to character n-grams.

A word seen in training scores each language by its log frequency there.  An
unseen word is scored by its longest character n-grams that training has seen,
falling back from five characters to one.  The score of a text is the sum over
its words; the reported score is the posterior of the best language.

Word and n-gram counts are Spark aggregates.  The model is a classifier and is
fitted on a bounded sample: at most about ``SAMPLE_ROWS`` labelled rows of each
language, chosen by a hash of the id.  Every value of ``lang`` is learned, however
rare.  Each language brings its ``MODEL_WORDS`` most frequent words and
``MODEL_GRAMS`` most frequent n-grams, those seen once included, and an entry that
one language brings keeps its counts in all of them.  So the size of the model
follows the number of languages and not the corpus, and a large language takes
nothing from a small one.  Every text is scored whole.

A count c of N in a language gives log((c + m p) / (N + m)), with p the mean
relative frequency of the entry over all languages and m ``PRIOR_COUNT``; so a
language with few rows has no better chances at words it has never seen.

Edge cases: null texts and texts without a letter are ``und`` with score 0, and
so is every text when no labelled row exists.  Rows with a null label teach
nothing.  Rows with a null id are not held out.  Ties go to the language that
sorts first.  Extra columns are dropped.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from nearlex.llm.base import arrow_step, bound_batches, remainder, replaced
from nearlex.session import broadcast_if_small, stage

#: Bounds of the fitted model, each for one language.
SAMPLE_ROWS = 4_000
MODEL_WORDS = 30_000
MODEL_GRAMS = 30_000
#: Values of unseen words remembered by a worker, and words scored at once.
HELD_VALUES = 1_000_000
WORDS_AT_ONCE = 4_096
LONGEST = 5
UNKNOWN = "und"
#: Weight of the mean over all languages, as a number of counts.
PRIOR_COUNT = 20.0


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case runs of letters of every text, and the row of each."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    parts = pc.split_pattern_regex(lowered, r"[^\p{L}]+")
    flat, rows = parts.flatten(), np.asarray(pc.list_parent_indices(parts))
    real = pc.not_equal(flat, "")
    return flat.filter(real), rows[np.asarray(real)]


def grams(word: str, size: int) -> list[str]:
    """Character n-grams of a word with a border on each side."""
    padded = f"_{word}_"
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


@dataclass
class Table:
    """Log frequencies of entries in every language.

    ``logs`` has one row an entry and one column a language; with ``starts`` it
    holds the counted values only, those of entry i from ``starts[i]`` on, in the
    languages ``columns``, and others are ``base[i] + shift[language]``.
    """

    place: dict[str, int]
    logs: np.ndarray
    starts: np.ndarray | None = None
    columns: np.ndarray | None = None
    base: np.ndarray | None = None
    shift: np.ndarray | None = None

    def rows(self, entries: list[int]) -> np.ndarray:
        if self.starts is None:
            return self.logs[entries]
        entries = np.asarray(entries, np.int64)
        out = self.base[entries][:, None] + self.shift
        first, size = self.starts[entries], self.starts[entries + 1] - self.starts[entries]
        row = np.repeat(np.arange(len(entries)), size)
        at = np.arange(len(row)) + np.repeat(first - (np.cumsum(size) - size), size)
        out[row, self.columns[at]] = self.logs[at]
        return out


@dataclass
class Model:
    languages: list[str]
    words: Table
    grams: Table
    prior: np.ndarray

    def pieces(self, word: str) -> list[int]:
        """The longest n-grams of a word that training has seen."""
        for size in range(LONGEST, 0, -1):
            found = [g for g in map(self.grams.place.get, grams(word, size)) if g is not None]
            if found:
                return found
        return []

    def word(self, word: str) -> np.ndarray:
        """Log score of a word in each language."""
        return self.score([word], {})[0]

    def score(self, words: list[str], held: dict[str, np.ndarray]) -> np.ndarray:
        """Log scores of words in each language, a row a word; ``held`` remembers unseen words."""
        out = np.zeros((len(words), len(self.languages)))
        place = [self.words.place.get(w, -1) for w in words]
        known = [i for i, p in enumerate(place) if p >= 0]
        out[known] = self.words.rows([place[i] for i in known])
        new: list[tuple[int, list[int]]] = []
        waiting = 0

        def settle() -> None:
            nonlocal waiting
            if new:
                sizes = np.array([len(found) for _, found in new])
                values = self.grams.rows([g for _, found in new for g in found])
                means = np.add.reduceat(values, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
                for (i, _), mean in zip(new, means):
                    out[i] = mean
                    if len(held) * out.shape[1] < HELD_VALUES and len(words[i]) < 40:
                        held[words[i]] = mean.copy()
            new.clear()
            waiting = 0

        for i, p in enumerate(place):
            if p >= 0:
                continue
            row = held.get(words[i])
            if row is not None:
                out[i] = row
                continue
            found = self.pieces(words[i])
            if found:
                new.append((i, found))
                waiting += len(found)
            if waiting > WORDS_AT_ONCE:
                settle()
        settle()
        return out

    def predict(self, column: pa.Array, held: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of every text; ``held`` remembers unseen words."""
        n, k = len(column), len(self.languages)
        words, rows = words_of(column)
        if not k or not len(words):
            return [UNKNOWN] * n, np.zeros(n)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        order = np.argsort(np.asarray(coded.indices), kind="stable")
        codes, rows_of = np.asarray(coded.indices)[order], rows[order]
        total = np.tile(self.prior, (n, 1))
        for first in range(0, len(distinct), WORDS_AT_ONCE):
            some = distinct[first : first + WORDS_AT_ONCE]
            table = self.score(some, held)
            part = slice(*np.searchsorted(codes, [first, first + len(some)]))
            for j in range(k):
                total[:, j] += np.bincount(rows_of[part], table[codes[part] - first, j], minlength=n)
        best = total.argmax(axis=1)
        posterior = 1.0 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
        known = np.bincount(rows, minlength=n) > 0
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
        return names, np.where(known, posterior, 0.0)


def _log_table(counts: pa.Table, languages: list[str], totals: np.ndarray) -> Table:
    """Log frequencies of every counted entry from its rows (lang, entry, n)."""
    coded = counted_codes(counts.column("entry"))
    entry, names = np.asarray(coded.indices), coded.dictionary.to_pylist()
    column = np.asarray(pc.index_in(counts.column("lang"), pa.array(languages, pa.string())))
    n = np.asarray(counts.column("n")).astype(np.float64)
    order = np.lexsort((column, entry))
    entry, column, n = entry[order], column[order], n[order]
    mean = np.bincount(entry, n / totals[column], minlength=len(names)) / max(len(languages), 1)
    shift = -np.log(totals + PRIOR_COUNT)
    logs = np.log(n + PRIOR_COUNT * mean[entry]) + shift[column]
    starts = np.searchsorted(entry, np.arange(len(names) + 1))
    return Table(dict(zip(names, range(len(names)))), logs, starts, column, np.log(PRIOR_COUNT * mean), shift)


def counted_codes(column: pa.ChunkedArray) -> pa.DictionaryArray:
    """One dictionary array of a column."""
    return column.combine_chunks().cast(pa.string()).dictionary_encode()


def _brought(counted: DataFrame, bound: int) -> pa.Table:
    """All counts of the entries that are among the ``bound`` most frequent of a language."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "entry")
    chosen = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= bound)
    return counted.join(chosen.select("entry").distinct(), "entry", "left_semi").select("lang", "entry", "n").toArrow()


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from rows with a label outside the hold-out."""
    bound_batches(docs.sparkSession)
    usable = docs.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & (remainder(F.col("doc_id"), 4) != 2)
    )
    sizes = stage(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows")), "languages")
    per = {r["lang"]: r["n_rows"] for r in sizes.collect()}  # one row a language
    nothing = Table({}, np.zeros((0, 0)))
    if not per:
        return Model([], nothing, nothing, np.zeros(0))
    languages = sorted(per)
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    sample = usable.join(broadcast_if_small(sizes), "lang").filter(chance < sample_rows / F.col("n_rows"))

    def count(batches):
        for batch in batches:
            words, rows = words_of(batch.column("text"))
            langs = batch.column("lang").take(pa.array(rows))
            counted = pa.table({"lang": langs, "entry": words}).group_by(["lang", "entry"]).aggregate([([], "count_all")])
            yield from counted.rename_columns(["lang", "entry", "n"]).combine_chunks().to_batches()

    counted = stage(
        sample.select("lang", "text").mapInArrow(count, "lang string, entry string, n bigint")
        .groupBy("lang", "entry").agg(F.sum("n").alias("n")),
        "language-words",
    )
    padded = F.concat(F.lit("_"), "entry", F.lit("_"))
    spans = F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("size")
    places = F.expr("transform(sequence(1, greatest(length(padded) - size + 1, 0)), i -> substring(padded, i, size))")
    pieces = stage(
        counted.select("lang", "n", padded.alias("padded"))
        .select("lang", "n", "padded", spans)
        .filter("length(padded) >= size")
        .select("lang", "n", F.explode(places).alias("entry"))
        .groupBy("lang", "entry")
        .agg(F.sum("n").alias("n")),
        "language-grams",
    )
    seen = {r["lang"]: float(r["n"]) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    totals = np.array([seen.get(name, 1.0) for name in languages])
    prior = np.array([math.log((per[name] + 1.0) / (sum(per.values()) + len(per))) for name in languages])
    words, parts = (_brought(table, bound) for table, bound in ((counted, MODEL_WORDS), (pieces, MODEL_GRAMS)))
    return Model(languages, _log_table(words, languages, totals), _log_table(parts, languages, totals), prior)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))  # bounded by language
    kind = dict(docs.dtypes)["doc_id"]
    held: dict[str, np.ndarray] = {}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = model.value.predict(batch.column("text"), held)
        return replaced(batch, "text", lang_pred=pa.array(names, pa.string()), score=pa.array(score))

    named = arrow_step(docs.select("doc_id", "text"), f"doc_id {kind}, lang_pred string, score double", step)
    return named.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, with a language whose posterior is at least ``threshold``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    held: dict[str, np.ndarray] = {}

    @pandas_udf("double")
    def score(text):
        names, value = model.value.predict(pa.array(text, pa.string(), from_pandas=True), held)
        return text.__class__(np.where([n != UNKNOWN for n in names], value, 0.0), index=text.index)

    return docs.filter(score(F.col("text")) >= threshold)
