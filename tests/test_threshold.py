import numpy as np
import pytest

from nearlex.operators import neighbours as nb, threshold as th

KIND = "doc_id bigint, vec array<struct<term_id:int,w:double>>"


def table(spark, matrix, first=0):
    rows = [(first + i, [(int(j), float(r[j])) for j in np.flatnonzero(r)]) for i, r in enumerate(matrix)]
    return spark.createDataFrame(rows, KIND)


def made(rows, terms, seed, filled=6, negative=False):
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, terms))
    for r in out[:-1]:  # the last row stays empty
        at = rng.choice(terms, filled, replace=False)
        r[at] = rng.random(filled) ** 3 + 0.01
        if negative:
            r[at[::2]] *= -1
        r /= np.linalg.norm(r)
    return out


def expected(q, t, bound, first):
    dots = q @ t.T
    return {(i, first + j): round(dots[i, j], 9) for i, j in zip(*np.nonzero(dots >= bound))}


@pytest.mark.parametrize("bound", [0.05, 0.4, 0.9])
@pytest.mark.parametrize("negative", [False, True])
def test_pairs_equal_brute_force(spark, bound, negative):
    q, t = made(40, 30, 1, negative=negative), made(90, 30, 2, negative=negative)
    t[3] = q[5]  # an equal pair
    got = th.similar(table(spark, q), table(spark, t, 1000), bound).collect()
    assert len(got) == len({(r["query_id"], r["train_id"]) for r in got})
    assert {(r["query_id"], r["train_id"]): round(r["dot"], 9) for r in got} == expected(q, t, bound, 1000)


def test_hot_term_is_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(th, "ROWS_PER_SALT", 5)
    q, t = made(40, 12, 3), made(60, 12, 4)
    q[:-1, 0], t[:-1, 0] = 1.0, 1.0  # a term of every row that carries most of it
    q[:-1] /= np.linalg.norm(q[:-1], axis=1)[:, None]
    t[:-1] /= np.linalg.norm(t[:-1], axis=1)[:, None]
    got = th.similar(table(spark, q), table(spark, t, 1000), 0.7).collect()
    assert {(r["query_id"], r["train_id"]): round(r["dot"], 9) for r in got} == expected(q, t, 0.7, 1000)


def test_vectors_of_other_lengths_than_one(spark):
    q, t = made(30, 20, 5) * 7.0, made(30, 20, 6) * 0.2
    got = th.similar(table(spark, q), table(spark, t, 1000), 0.5).collect()
    assert {(r["query_id"], r["train_id"]): round(r["dot"], 9) for r in got} == expected(q, t, 0.5, 1000)


def text_like(rows, seed, terms=2000, filled=30):
    """Terms by rank: chosen in proportion to 1 / rank, weighted by their rarity."""
    rng = np.random.default_rng(seed)
    share = 1.0 / np.arange(1, terms + 1)
    share /= share.sum()
    out = np.zeros((rows, terms))
    for r in out:
        at = rng.choice(terms, filled, replace=False, p=share)
        r[at] = -np.log(share[at])
        r /= np.linalg.norm(r)
    return out


# The bound knows only norms, so evenly spread terms leave more pairs than texts do.
@pytest.mark.parametrize("kind,bound,left", [("text", 0.6, 0.1), ("text", 0.3, 0.3), ("even", 0.9, 0.3)])
def test_share_of_the_overlapping_pairs_that_meets(spark, kind, bound, left):
    q, t = (text_like(100, 7), text_like(300, 8)) if kind == "text" else (made(100, 400, 7, 30), made(300, 400, 8, 30))
    sides = table(spark, q), table(spark, t, 1000)
    met = {tuple(r) for r in th.candidates(*sides, bound).collect()}
    assert set(expected(q, t, bound, 1000)) <= met
    assert len(met) < left * nb.dot_products(*sides).count()


def test_empty_tables_and_wrong_ids(spark):
    some, none = table(spark, made(5, 9, 9)), spark.createDataFrame([], KIND)
    assert th.similar(some, none, 0.1).count() == 0 == th.similar(none, some, 0.1).count()
    for ids in ([1, 1], [1, None]):
        bad = spark.createDataFrame([(i, [(0, 1.0)]) for i in ids], KIND)
        with pytest.raises(ValueError):
            th.similar(some, bad, 0.1)
    with pytest.raises(ValueError):
        th.similar(some, some, 0.0)
