"""Named configurations of tokens, weights, vocabulary and selection."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearlex.functions import porter, text as tx
from nearlex.functions.stopwords import ENGLISH
from nearlex.operators import bags as bg, lsi as ls, selection, vectors as vx
from nearlex.operators.vocabulary import fit_vocabulary



@dataclass(frozen=True)
class Representation:
    """How a text becomes a vector.

    ``tokens``: ``simple`` | ``rich`` | ``raw`` | ``lemma`` | ``char`` | ``char_wb``
    ``lemmas``: words of the ``simple`` path are replaced by the lemma table, which wins over stems
    ``weight``: ``bm25`` | ``sublinear`` | ``tfidf`` | ``log_tfidf``
    ``chi2``:   terms kept by chi-squared, 0 for all
    """

    tokens: str = "rich"
    max_order: int = 3
    weight: str = "bm25"
    min_df: int = 2
    max_df: float | None = None
    max_terms: int | None = 150_000
    cap_by: str = "df"
    chi2: int = 120_000
    k1: float = 1.2
    b: float = 0.5
    n_min: int = 3
    n_max: int = 5
    stop_words: tuple[str, ...] = ENGLISH
    stemmed: bool = False
    lemmas: bool = False


@dataclass(frozen=True)
class LsiSpec:
    """Components of ``base``: added to an ensemble, in its place where it is the only member."""

    base: str = "bm25"
    components: int = 300
    passes: int = 7
    seed: int = 42


@dataclass
class Fitted:
    vocab: DataFrame
    train: DataFrame
    queries: DataFrame | None
    avgdl: float


# The three script presets and the representation weights.
SIMPLE = Representation(
    tokens="simple", weight="tfidf", max_df=0.95, max_terms=None, cap_by="total", chi2=0
)
BM25 = Representation()
SUBLINEAR = Representation(weight="sublinear")
CHAR_WB = Representation(
    tokens="char_wb", weight="log_tfidf", min_df=3, max_df=0.95, max_terms=100_000,
    cap_by="total", chi2=0,
)
ENSEMBLE = {
    "bm25": replace(BM25, chi2=60_000),
    "sublinear": replace(SUBLINEAR, chi2=60_000),
    "char": CHAR_WB,
}
ENSEMBLE_WEIGHTS = {"bm25": 1.0, "sublinear": 1.0, "char": 0.6, "lsi": 0.4}

# The numbered models; m9, m10 and m13 are 300 components of
# another model before selection, m11 is feedback expansion of m1.
MODELS: dict[str, Representation] = {
    "m1": Representation(max_order=3, weight="bm25", max_terms=300_000, chi2=200_000),
    "m2": Representation(max_order=2, weight="sublinear"),
    "m3": Representation(max_order=1, weight="bm25", max_terms=50_000, chi2=50_000),
    "m4": Representation(max_order=2, weight="bm25"),
    "m5": Representation(tokens="lemma", max_order=2, weight="bm25"),
    "m6": Representation(tokens="raw", max_order=2, weight="bm25"),
    "m7": Representation(tokens="lemma", max_order=2, weight="sublinear"),
    "m8": Representation(max_order=3, weight="sublinear", max_terms=300_000, chi2=200_000),
    "m12": Representation(
        tokens="char", weight="sublinear", min_df=3, max_terms=200_000, chi2=150_000
    ),
}
REDUCED_MODELS = {"m9": "m8", "m10": "m1", "m13": "m12"}
REDUCTIONS = {
    "m9": LsiSpec("m8", 300, 5, 42), "m10": LsiSpec("m1", 300, 5, 17), "m13": LsiSpec("m12", 300, 5, 7),
}


def enabled(
    bm25: bool = True, sublinear: bool = True, char: bool = True
) -> dict[str, Representation]:
    """The ensemble's representations that are switched on."""
    on = {"bm25": bm25, "sublinear": sublinear, "char": char}
    return {name: spec for name, spec in ENSEMBLE.items() if on[name]}


def analyzer(spec: Representation) -> bg.Analyzer:
    if spec.tokens == "simple":
        return bg.simple_analyzer(spec.stop_words, porter.stem if spec.stemmed and not spec.lemmas else None)
    if spec.tokens == "rich":
        return bg.rich_analyzer(spec.max_order, spec.stop_words)
    if spec.tokens == "raw":
        return bg.rich_analyzer(spec.max_order, spec.stop_words, None)
    if spec.tokens == "lemma":
        return bg.rich_analyzer(1, spec.stop_words, None)
    if spec.tokens == "char":
        return lambda text: tx.char_grams(text, spec.n_min, spec.n_max)
    if spec.tokens == "char_wb":
        return lambda text: tx.char_grams_in_word(text, spec.n_min, spec.n_max)
    raise ValueError(f"unknown tokens {spec.tokens!r}")


def bag_of(spec: Representation, docs: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    tokens = bg.tokenised(docs, analyzer(spec))
    if spec.tokens == "simple" and spec.lemmas:
        if lemmas is None:
            raise ValueError("lemma tokens need a token, lemma table")
        return bg.bags(bg.normalised_by_table(tokens, lemmas))
    if spec.tokens == "lemma":
        if lemmas is None:
            raise ValueError("lemma tokens need a token, lemma table")
        words = bg.normalised_by_table(tokens, lemmas)
        tokens = words.withColumn("tokens", tx.with_ngrams(F.col("tokens"), spec.max_order))
    return bg.bags(tokens)


def weighting(spec: Representation, avgdl: float) -> vx.Weight:
    if spec.weight == "bm25":
        return vx.bm25_weight(avgdl, spec.k1, spec.b)
    if spec.weight == "sublinear":
        return vx.sublinear_weight()
    if spec.weight in ("tfidf", "log_tfidf"):
        return vx.tfidf_weight(spec.weight == "log_tfidf")
    raise ValueError(f"unknown weight {spec.weight!r}")


def build(
    spec: Representation, train: DataFrame, queries: DataFrame | None = None,
    lemmas: DataFrame | None = None, select: bool = True, held: dict | None = None,
) -> Fitted:
    """Fit on ``train`` (doc_id, label, text) and transform ``queries`` (doc_id, text).

    Queries use the fitted vocabulary, IDF and average length.  ``held`` keeps
    the counts for another representation of the same tokens and texts, also
    those of the vocabulary where its bounds are the same.
    """
    counts = (spec.tokens, spec.max_order, spec.n_min, spec.n_max, spec.stop_words, spec.stemmed, spec.lemmas)
    held = {} if held is None else held

    def counted(side: str, docs: DataFrame) -> DataFrame:
        if (side, counts) not in held:
            held[side, counts] = bag_of(spec, docs, lemmas)
        return held[side, counts]

    bag = counted("train", train)
    n_docs, avgdl = bg.corpus_stats(bag)
    vocab = fit_vocabulary(
        bag, n_docs, min_df=spec.min_df, max_df=spec.max_df, max_terms=spec.max_terms,
        cap_by=spec.cap_by, idf="bm25" if spec.weight == "bm25" else "smooth", held=held.setdefault(("terms", counts), {}),
    )
    weight = weighting(spec, avgdl)
    fit = vx.weigh(bag, vocab, weight)
    asked = None if queries is None else vx.weigh(counted("queries", queries), vocab, weight)
    if select and spec.chi2 > 0:
        others = [] if asked is None else [asked]
        chosen = selection.select_features(fit, vocab, spec.chi2, *others)
        fit, asked = chosen[0], (chosen[1] if others else None)
    return Fitted(vocab, fit, asked, avgdl)


def reduce(train: DataFrame, queries: DataFrame | None, spec: LsiSpec):
    """Dense rows of both tables on the components fitted on ``train``."""
    fitted = ls.fit_components(train, spec.components, spec.passes, spec.seed)
    asked = None if queries is None else ls.project(queries, fitted)
    return ls.project(train, fitted), asked


