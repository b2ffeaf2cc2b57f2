"""Named configurations end to end: labelled documents, unlabelled questions.

Each returns the class scores of every question, so a changed vector, neighbour
or vote shows.
"""

from __future__ import annotations



from dataclasses import replace

from catalog import data, sql
from catalog.count_queries import r6
from catalog.registry import query
from catalog.model_sql import CHARS, CHARS_WB, K, LEMMAS, RAW, SUFFIXED, lemma_tokens, scores_sql, stemmed
from catalog.text_queries import plural_lemmas
from nearlex.operators import lsi, neighbours as nb, votes
from nearlex.plans import classify as cl, presets as ps
from nearlex.session import stage

def _scores(queries, train, power: float = 1.0):
    found = nb.nearest(queries, train, K, fill=False)
    return votes.class_scores(found, power, None).select("query_id", "label", r6("score"))


@data.shared
def lemma_table(spark, sf):
    return stage(plural_lemmas(spark, sf), "lemmas")


@data.shared
def unselected(spark, sf, name):
    lemmas = lemma_table(spark, sf) if ps.MODELS[name].tokens == "lemma" else None
    docs, asked = data.documents(spark, sf), data.questions(spark, sf)
    return ps.build(ps.MODELS[name], docs, asked, lemmas, select=False)


@data.shared
def model(spark, sf, name):
    from nearlex.operators.selection import select_features

    built = unselected(spark, sf, name)
    return select_features(built.train, built.vocab, ps.MODELS[name].chi2, built.queries)


def _register(name: str, tokens: tuple[str, ...]) -> None:
    @query(scores_sql(ps.MODELS[name], *tokens))
    def run(spark, sf):
        train, asked = model(spark, sf, name)
        return _scores(asked, train)

    _rename(run, f"{name}_scores", "run")


def _rename(fn, name: str, old: str) -> None:
    from catalog.registry import ORACLES, QUERIES

    fn.__name__ = name
    QUERIES[name] = QUERIES.pop(old)
    if old in ORACLES:
        ORACLES[name] = ORACLES.pop(old)


for _name, _tokens in {
    "m1": stemmed(3), "m2": stemmed(2), "m3": stemmed(1), "m4": stemmed(2), "m5": LEMMAS,
    "m6": RAW, "m7": LEMMAS, "m8": stemmed(3), "m12": CHARS,
}.items():
    _register(_name, _tokens)


def _reduced(spark, sf, name: str):
    base = unselected(spark, sf, ps.REDUCTIONS[name].base)
    spec = ps.REDUCTIONS[name]
    fitted = lsi.fit_components(base.train, spec.components, spec.passes, spec.seed)
    return _scores(lsi.project(base.queries, fitted), lsi.project(base.train, fitted))


@query()
def m9_scores(spark, sf):
    return _reduced(spark, sf, "m9")


@query()
def m10_scores(spark, sf):
    return _reduced(spark, sf, "m10")


@query()
def m13_scores(spark, sf):
    return _reduced(spark, sf, "m13")


def _feedback_sql() -> str:
    body = scores_sql(ps.MODELS["m1"], *stemmed(3))
    head, _ = body.rsplit("SELECT query_id, label, round(", 1)
    near10 = sql.nearest("n10", "s", "d", 10)
    extra = [
        near10, "z AS (SELECT query_id, sum(sim) AS total FROM n10 GROUP BY query_id)",
        "m_raw AS (SELECT doc_id, term, sum(w) AS w FROM (SELECT doc_id, term, 0.9 * w AS w FROM qs UNION ALL "
        "SELECT query_id, term, 0.1 * sim / greatest(total, 1e-9) * w FROM n10 JOIN z USING (query_id) JOIN ts ON ts.doc_id = train_id) GROUP BY 1, 2)",
        f"m AS MATERIALIZED ({sql.unit('m_raw')})", sql.dots("s2", "m", "ts"), sql.nearest("nn2", "s2", "d", K),
    ]
    return head.rstrip() + ",\n" + ",\n".join(extra) + (
        "\nSELECT query_id, label, round(sum(sim), 6) AS score FROM nn2 GROUP BY query_id, label"
    )


@query(_feedback_sql())
def m11_scores(spark, sf):
    from nearlex.operators.feedback import expand_weighted

    train, asked = model(spark, sf, "m1")
    return _scores(expand_weighted(asked, train), train)


_SIMPLE_DOCS = f"list_filter({sql.LETTERS}, lambda t: NOT list_contains({sql.STOP_LIST}, t))"


@query(scores_sql(ps.SIMPLE, sql.DOCS, sql.ASKED, sql.tokens("dt", "d", _SIMPLE_DOCS),
                  sql.tokens("qt", "q", _SIMPLE_DOCS, label=False), power=2.0))
def script_tfidf_scores(spark, sf):
    built = ps.build(ps.SIMPLE, data.documents(spark, sf), data.questions(spark, sf))
    return _scores(built.queries, built.train, 2.0)


_LEMMA_SPEC = replace(ps.SIMPLE, lemmas=True)


@query(scores_sql(ps.SIMPLE, sql.DOCS, sql.ASKED, SUFFIXED, lemma_tokens("dt", "d", True, _SIMPLE_DOCS, 1),
                  lemma_tokens("qt", "q", False, _SIMPLE_DOCS, 1), power=2.0))
def script_tfidf_lemma_scores(spark, sf):
    docs, asked = data.documents(spark, sf), data.questions(spark, sf)
    built = ps.build(_LEMMA_SPEC, docs, asked, lemma_table(spark, sf))
    return _scores(built.queries, built.train, 2.0)


def _script(spark, sf, spec):
    built = ps.build(spec, data.documents(spark, sf), data.questions(spark, sf))
    return _scores(built.queries, built.train, 2.0)


@query(scores_sql(ps.BM25, *stemmed(3), power=2.0))
def script_bm25_scores(spark, sf):
    return _script(spark, sf, ps.BM25)


@query(scores_sql(ps.SUBLINEAR, *stemmed(3), power=2.0))
def script_sublinear_scores(spark, sf):
    return _script(spark, sf, ps.SUBLINEAR)


@query(scores_sql(ps.CHAR_WB, *CHARS_WB, power=2.0))
def script_char_scores(spark, sf):
    return _script(spark, sf, ps.CHAR_WB)


@query()
def script_bm25_lsi_predictions(spark, sf):
    """One representation with its components in place of the matrix."""
    predicted, _ = cl.classify(
        data.documents(spark, sf), data.questions(spark, sf), {"bm25": ps.BM25},
        lsi=ps.LsiSpec(components=100), val_size=None,
    )
    return predicted


@query()
def script_ensemble_predictions(spark, sf):
    """All four representations, feedback on the BM25 queries, no hold-out."""
    predicted, _ = cl.classify(
        data.documents(spark, sf), data.questions(spark, sf), ps.ENSEMBLE, ps.ENSEMBLE_WEIGHTS,
        lsi=ps.LsiSpec(components=300), prf_n=10, val_size=None,
    )
    return predicted
