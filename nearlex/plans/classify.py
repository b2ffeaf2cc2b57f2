"""Fit and predict surfaces: one representation, several, and from text files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearlex.operators import ensemble, neighbours as nb, splits, votes
from nearlex.operators.feedback import expand_uniform
from nearlex.operators.metrics import macro_f1
from nearlex.plans import presets as ps
from nearlex.session import stage
from nearlex.sources import lines, predictions


class NeighbourClassifier:
    """k-nearest-neighbour classifier over vector tables.

    ``fit`` takes ``doc_id, label, vec``; ``predict`` takes ``doc_id, vec`` and
    returns ``query_id, pred`` for every query.  ``voting`` is honoured here;
    ``predict_scores`` always returns similarity-weighted class scores.
    """

    def __init__(
        self, k: int, metric: str = "cosine", voting: str = "majority", sim_power: float = 1.0,
        plan: str = "auto",
    ) -> None:
        if k < 1:
            raise ValueError("k must be >= 1")
        if metric not in ("cosine", "euclidean"):
            raise ValueError("metric must be 'cosine' or 'euclidean'")
        if voting not in ("majority", "weighted"):
            raise ValueError("voting must be 'majority' or 'weighted'")
        self.k, self.metric, self.voting = k, metric, voting
        self.sim_power, self.plan = sim_power, plan
        self._train: DataFrame | None = None
        self._lowest = 1

    def fit(self, train: DataFrame) -> "NeighbourClassifier":
        if self.metric == "euclidean" and not nb._is_sparse(train):
            raise ValueError("dense Euclidean search is not offered; use cosine")
        self._train = train
        low = train.agg(F.min("label")).first()[0]
        self._lowest = 1 if low is None else int(low)
        return self

    def neighbours(self, queries: DataFrame) -> DataFrame:
        if self._train is None:
            raise RuntimeError("call fit() before predict()")
        fill = self.voting == "majority"
        return nb.nearest(
            queries, self._train, self.k, metric=self.metric, fill=fill, plan=self.plan
        )

    def predict(self, queries: DataFrame) -> DataFrame:
        found = self.neighbours(queries)
        if self.voting == "majority":
            scores = votes.class_counts(found)
        else:
            scores = votes.class_scores(found, self.sim_power, None)
        return votes.for_all_queries(votes.decide(scores), queries, self._lowest)

    def predict_scores(self, queries: DataFrame) -> DataFrame:
        return votes.class_scores(self.neighbours(queries), self.sim_power, True)


class EnsembleClassifier:
    """One neighbour search per named representation, scores added with weights."""

    def __init__(
        self, k: int = 9, metric: str = "cosine", sim_power: float = 2.0,
        rep_weights: Mapping[str, float] | None = None, plan: str = "auto",
    ) -> None:
        self.k, self.metric, self.sim_power, self.plan = k, metric, sim_power, plan
        self.rep_weights = dict(rep_weights or {})
        self._members: dict[str, NeighbourClassifier] = {}

    def fit(self, train: Mapping[str, DataFrame]) -> "EnsembleClassifier":
        self._members = {}
        for name, vectors in train.items():
            member = NeighbourClassifier(
                self.k, self.metric, "weighted", self.sim_power, self.plan
            )
            self._members[name] = member.fit(vectors)
        return self

    def member_scores(self, queries: Mapping[str, DataFrame]) -> DataFrame:
        if not self._members:
            raise RuntimeError("call fit() before predict()")
        tables = [
            self._members[name].predict_scores(v).select(
                F.lit(name).alias("rep"), "query_id", "label", "score"
            )
            for name, v in queries.items()
        ]
        every = tables[0]
        for t in tables[1:]:
            every = every.unionByName(t)
        return every

    def predict_scores(self, queries: Mapping[str, DataFrame]) -> DataFrame:
        return ensemble.weighted_sum(self.member_scores(queries), self.rep_weights)

    def predict(self, queries: Mapping[str, DataFrame]) -> DataFrame:
        decided = votes.decide(self.predict_scores(queries))
        lowest = min(m._lowest for m in self._members.values())
        return votes.for_all_queries(decided, next(iter(queries.values())), lowest)


def holdout_f1(
    features: Mapping[str, DataFrame], k: int = 11, metric: str = "cosine",
    sim_power: float = 2.0, rep_weights: Mapping[str, float] | None = None,
    voting: str = "weighted", val_size: float = 0.1, seed: int = 42,
) -> DataFrame:
    """Macro-F1 on a stratified hold-out of already fitted features."""
    first = next(iter(features.values()))
    split = stage(splits.stratified_holdout(first, val_size, seed), "holdout")
    fit, val = {}, {}
    for name, vectors in features.items():
        fit[name], val[name] = splits.parts(vectors, split)
    if len(features) == 1 and rep_weights is None:
        name = next(iter(features))
        model = NeighbourClassifier(k, metric, voting, sim_power).fit(fit[name])
        predicted = model.predict(val[name].drop("label"))
    else:
        model = EnsembleClassifier(k, metric, sim_power, rep_weights).fit(fit)
        predicted = model.predict({n: v.drop("label") for n, v in val.items()})
    truth = split.filter("is_val").select(
        F.col("doc_id").alias("query_id"), F.col("label").alias("truth")
    )
    return macro_f1(truth.join(predicted, "query_id"))


def refitted_holdout_f1(
    docs: DataFrame, spec: "ps.Representation", k: int = 11, sim_power: float = 2.0,
    voting: str = "weighted", val_size: float = 0.1, seed: int = 42, lemmas: DataFrame | None = None,
) -> DataFrame:
    """Macro-F1 with the vocabulary and selection fitted on the fit part only."""
    split = stage(splits.stratified_holdout(docs, val_size, seed), "holdout")
    fit_docs, val_docs = splits.parts(docs, split)
    fitted = ps.build(spec, fit_docs, val_docs.drop("label"), lemmas)
    model = NeighbourClassifier(k, "cosine", voting, sim_power).fit(fitted.train)
    truth = val_docs.select(F.col("doc_id").alias("query_id"), F.col("label").alias("truth"))
    return macro_f1(truth.join(model.predict(fitted.queries), "query_id"))


def classify(
    train: DataFrame, queries: DataFrame, specs: Mapping[str, "ps.Representation"],
    weights: Mapping[str, float] | None = None, *, k: int = 11, metric: str = "cosine",
    sim_power: float = 2.0, voting: str = "weighted", lsi: "ps.LsiSpec | None" = None,
    prf_n: int = 0, prf_alpha: float = 0.8, val_size: float | None = 0.1, seed: int = 42,
    lemmas: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Predictions for ``queries`` and the hold-out macro-F1 (or ``None``).

    ``lemmas`` (token, lemma) serves the representations that use lemmas.  LSI
    joins an ensemble as one more member and takes the place of a single
    representation.  Feedback expands the ``bm25`` queries only, never the
    hold-out rows.
    """
    if lsi is not None and lsi.base not in specs:
        raise ValueError(f"LSI needs the {lsi.base!r} representation")
    if lsi is not None and metric != "cosine":
        raise ValueError("LSI requires cosine similarity")
    fit, asked = {}, {}
    held: dict = {}
    for name, spec in specs.items():
        built = ps.build(spec, train, queries, lemmas, held=held)
        fit[name], asked[name] = built.train, built.queries
    if lsi is not None:
        single = len(specs) == 1 and not weights
        fit["lsi"], asked["lsi"] = ps.reduce(fit[lsi.base], asked[lsi.base], lsi)
        if single:
            fit, asked = {"lsi": fit["lsi"]}, {"lsi": asked["lsi"]}
    f1 = None
    if val_size:
        one = len(fit) == 1 and not weights
        f1 = holdout_f1(
            fit, k, metric, sim_power, None if one else weights or {}, voting, val_size, seed
        )
    if prf_n > 0 and "bm25" in asked:
        asked["bm25"] = expand_uniform(asked["bm25"], fit["bm25"], prf_n, prf_alpha)
    if len(fit) == 1 and not weights:
        name = next(iter(fit))
        model = NeighbourClassifier(k, metric, voting, sim_power).fit(fit[name])
        predicted = model.predict(asked[name])
    else:
        model = EnsembleClassifier(k, metric, sim_power, weights).fit(fit)
        predicted = model.predict(asked)
    return predicted.select(F.col("query_id").alias("doc_id"), "pred"), f1


def classify_files(
    spark: SparkSession, train_path: str, query_path: str, output_path: str,
    specs: Mapping[str, "ps.Representation"], weights: Mapping[str, float] | None = None,
    *, max_train_rows: int | None = None, as_lines: bool = True, **options,
) -> DataFrame | None:
    """Read labelled and unlabelled files, classify, write; returns the hold-out F1."""
    train = stage(lines.read_labelled(spark, train_path, max_rows=max_train_rows), "train")
    queries = stage(lines.read_unlabelled(spark, query_path), "queries")
    predicted, f1 = classify(train, queries, specs, weights, **options)
    write = predictions.write_lines if as_lines else predictions.write_keyed
    write(predicted, output_path)
    return f1
