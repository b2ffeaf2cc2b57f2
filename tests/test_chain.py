import os

import pytest

from catalog import data
from nearlex.operators import ensemble, splits
from nearlex.operators.metrics import macro_f1
from nearlex.operators.sweeps import judged
from nearlex.operators import votes
from nearlex.plans import chain, presets as ps
from nearlex.session import stage

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
SPECS = {"m1": ps.MODELS["m1"], "m3": ps.MODELS["m3"]}


@pytest.fixture(scope="module")
def tuned(spark):
    turns = data.turns(spark, FOLDER)
    built = chain.members(turns, data.questions(spark, FOLDER), SPECS, {"m10": ps.LsiSpec("m1", 4, 2, 17)})
    split = stage(splits.random_split(turns.select("doc_id", "label")), "split")
    return built, chain.tune(built.train, split, 1, sparse_ks=(1, 5, 9), dense_ks=(3, 7), powers=(1.0, 2.0), temperatures=(1.0, 2.0))


def test_reduced_and_feedback_members_take_part(tuned):
    _, found = tuned
    assert set(found.ks) == {"m1", "m3", "m10", "m11"} == set(found.weights)
    assert found.ks["m10"] in (3, 7) and all(found.ks[n] in (1, 5, 9) for n in ("m1", "m3", "m11"))
    assert found.grid.count() == 4


def test_the_chosen_setting_scores_what_the_grid_says(tuned):
    _, found = tuned
    shares = chain.member_shares(found.found, found.power, found.temperature)
    decided = votes.decide(ensemble.weighted_sum(shares, found.weights))
    assert macro_f1(judged(decided, found.truth, 1)).first()[0] == pytest.approx(found.macro_f1)


def test_searched_weights_score_their_f1_and_no_less(tuned):
    _, found = tuned
    weights, f1 = chain.search_weights(found)
    shares = chain.member_shares(found.found, found.power, found.temperature)
    decided = votes.decide(ensemble.weighted_sum(shares, weights))
    assert f1 >= found.macro_f1 and sum(weights.values()) == pytest.approx(1.0)
    assert macro_f1(judged(decided, found.truth, 1)).first()[0] == pytest.approx(f1)


def test_every_question_is_answered(spark, tuned):
    built, found = tuned
    blank = spark.createDataFrame([(-1, "zzzz qqqq")], "doc_id bigint, text string")
    asked = data.questions(spark, FOLDER).unionByName(blank)
    turns = data.turns(spark, FOLDER)
    own = chain.members(turns, asked, SPECS, {"m10": ps.LsiSpec("m1", 4, 2, 17)})
    got = {r["query_id"]: r["pred"] for r in chain.predict(own, found, found.weights).collect()}
    assert len(got) == asked.count() and got[-1] == 1


def test_grid_winner_goes_into_the_bm25_members(spark):
    grid = spark.createDataFrame([(1.2, 0.5, 0.7), (2.0, 0.75, 0.9), (1.5, 1.0, 0.9)], "k1 double, b double, macro_f1 double")
    got = chain.tuned_specs({"m1": ps.MODELS["m1"], "m2": ps.MODELS["m2"]}, grid)
    assert (got["m1"].k1, got["m1"].b) == (1.5, 1.0) and got["m2"] == ps.MODELS["m2"]
    with pytest.raises(ValueError):
        chain.members(None, None, {}, {"m10": ps.LsiSpec("m1")})


def test_feedback_does_not_search_what_its_base_has_found(spark, tuned, monkeypatch):
    from nearlex.operators import feedback

    built, found = tuned
    turns, asked = built.train["m1"], built.queries["m1"]
    want = {r["doc_id"]: r["vec"] for r in feedback.expand_weighted(asked, turns).collect()}
    calls = []
    monkeypatch.setattr(feedback, "nearest", lambda *args, **kw: calls.append(args))
    seen = {}
    real = chain.expand_weighted
    monkeypatch.setattr(chain, "expand_weighted", lambda *args, **kw: seen.setdefault("vec", real(*args, **kw)))
    chain._searched(built.queries, built.train, {"m11": 3, "m1": 12}, chain.FEEDBACK, fill=True)
    got = {r["doc_id"]: r["vec"] for r in seen["vec"].collect()}
    assert not calls and got.keys() == want.keys()
    for i, vec in want.items():
        kept = {e["term_id"]: e["w"] for e in vec if e["w"]}
        assert {e["term_id"]: e["w"] for e in got[i] if e["w"]} == pytest.approx(kept)
