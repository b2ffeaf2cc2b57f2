import numpy as np
import pytest
from pyspark.sql import functions as F

from nearlex.operators import feedback, neighbours as nb, votes
from nearlex.plans.classify import EnsembleClassifier, NeighbourClassifier

SPARSE = "array<struct<term_id:int,w:double>>"


def random_table(spark, rows, terms, seed, label=True, first_id=0, hot=True):
    """Sparse unit rows; term 0 is in nearly every row, some rows are empty or equal."""
    rng = np.random.default_rng(seed)
    dense = np.where(rng.random((rows, terms)) < 0.15, rng.random((rows, terms)), 0.0)
    if hot:
        dense[:, 0] = 0.3
    dense[3] = dense[5]
    dense[7] = 0
    norms = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = dense / np.where(norms == 0, 1, norms)
    data = []
    for i in range(rows):
        vec = [(int(j), float(dense[i, j])) for j in np.flatnonzero(dense[i])]
        data.append((first_id + i, i % 4 + 1, vec) if label else (first_id + i, vec))
    kind = f"doc_id bigint, {'label int, ' if label else ''}vec {SPARSE}"
    return dense, spark.createDataFrame(data, kind).repartition(3)


def brute(q, t, k, metric):
    if metric == "cosine":
        value = np.round(q @ t.T, 6)
        merit = -value
    else:
        value = np.round(np.maximum((q**2).sum(1)[:, None] + (t**2).sum(1)[None] - 2 * q @ t.T, 0), 6)
        merit = value
    order = np.argsort(merit, axis=1, kind="stable")[:, :k]
    return {i: [(int(j), round(float(value[i, j]), 5)) for j in order[i]] for i in range(len(q))}


def collected(found, value, first_id):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"] - first_id, []).append((r["train_id"], round(r[value], 5)))
    return out


@pytest.mark.parametrize("metric, value", [("cosine", "sim"), ("euclidean", "dist2")])
@pytest.mark.parametrize("k", [5, 500])
def test_plans_equal_brute_force(spark, metric, value, k, monkeypatch):
    t, train = random_table(spark, 160, 30, 1)
    q, queries = random_table(spark, 23, 30, 2, label=False, first_id=1000, hot=False)
    want = brute(q, t, k, metric)
    assert collected(nb.nearest(queries, train, k, metric=metric, plan="blocks"), value, 1000) == want
    assert collected(nb.nearest(queries, train, k, metric=metric, plan="join"), value, 1000) == want
    monkeypatch.setattr(nb, "ROWS_PER_SALT", 7)
    assert collected(nb.nearest(queries, train, k, metric=metric, plan="join"), value, 1000) == want


@pytest.mark.parametrize("fill", [True, False])
def test_pruned_plan_equals_blocks(spark, fill):
    _, train = random_table(spark, 160, 30, 1)
    _, queries = random_table(spark, 23, 30, 2, label=False, first_id=1000)
    for k in (5, 500):
        want = nb.blocked(queries, train, k, fill=fill)
        got = nb.pruned(queries, train, k, fill=fill, rows=20)
        assert collected(got, "sim", 1000) == collected(want, "sim", 1000)


@pytest.mark.parametrize("k", [1, 6, 500])
def test_pruned_distances_equal_brute_force(spark, monkeypatch, k):
    """Rows of several norms, empty rows among them, which are nearer to a query than unrelated documents."""
    monkeypatch.setattr(nb, "QUERY_BLOCK_ROWS", 4)
    t, train = random_table(spark, 160, 60, 1, hot=False)
    q, queries = random_table(spark, 23, 60, 2, label=False, first_id=1000, hot=False)
    scale = 1.0 + (np.arange(160) % 4)
    times = F.transform("vec", lambda e: F.struct(e["term_id"].alias("term_id"), (e["w"] * (1 + F.col("doc_id") % 4)).alias("w")))
    train = train.withColumn("vec", times)
    got = nb.pruned(queries, train, k, rows=20, metric="euclidean")
    assert collected(got, "dist2", 1000) == brute(q, t * scale[:, None], k, "euclidean")
    found = nb.nearest(queries, train, k, metric="euclidean", plan="pruned")
    assert collected(found, "dist2", 1000) == brute(q, t * scale[:, None], k, "euclidean")


def test_cells_of_the_pruned_plan_are_bounded(spark):
    """A block that every query reaches is cut by its queries; long documents are cut by their entries."""
    cells = spark.range(1000).select(F.col("id").alias("query_id"), F.when(F.col("id") < 900, 0).otherwise(F.col("id")).cast("long").alias("_j"))
    sizes = nb.query_parts(cells, 100).groupBy("_j", "_i").count()
    assert sizes.agg(F.max("count")).first()[0] < 200 and sizes.agg(F.sum("count")).first()[0] == 1000
    rows = [(i, 1, [(0, 1.0)] + [(j, 0.1) for j in range(1, 40 if i % 2 else 2)]) for i in range(400)]
    train = spark.createDataFrame(rows, f"doc_id bigint, label int, vec {SPARSE}")
    blocks = nb.content_blocks(train, 1_000, 800)
    held = blocks.groupBy("_j").agg(F.sum(F.size("vec")).alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 2 * 800 and blocks.count() == 400


def test_ids_must_name_a_row_in_every_plan(spark):
    vec = [(0, 1.0)]
    kind = f"doc_id bigint, vec {SPARSE}"
    good = spark.createDataFrame([(1, vec), (2, vec)], kind)
    for rows in ([(1, vec), (1, vec)], [(None, vec), (1, vec)]):
        bad = spark.createDataFrame(rows, kind)
        for plan in ("auto", "join", "blocks", "pruned"):
            for metric in ("cosine", "euclidean"):
                for pair in ((good, bad), (bad, good)):
                    with pytest.raises(ValueError, match="unique"):
                        nb.nearest(*pair, 1, metric=metric, plan=plan)


def test_negative_weights_are_not_pruned(spark, monkeypatch):
    kind = f"doc_id bigint, vec {SPARSE}"
    train = spark.createDataFrame([(i, [(0, 1.0 - i), (1, 0.5)]) for i in range(6)], kind)
    asked = spark.createDataFrame([(9, [(0, -1.0)])], kind)
    with pytest.raises(ValueError):
        nb.nearest(asked, train, 2, plan="pruned")
    monkeypatch.setattr(nb, "PRUNED_ROWS", 1)
    assert [r["train_id"] for r in nb.nearest(asked, train, 2).orderBy("rank").collect()] == [5, 4]


def test_pruned_plan_visits_few_cells_of_clustered_rows(spark, monkeypatch):
    """Twenty groups with terms of their own: a query meets its own block and its neighbour at most."""
    rows = [(i, 1, [(10 * (i % 20) + j, 0.5) for j in range(4)]) for i in range(400)]
    train = spark.createDataFrame(rows, "doc_id bigint, label int, vec array<struct<term_id: int, w: double>>")
    asked = train.filter("doc_id < 40").select((nb.F.col("doc_id") + 1000).alias("doc_id"), "vec")
    cells = []
    inner = nb._multiplied

    def counted(q, t, *rest):
        cells.append(q.count())
        return inner(q, t, *rest)

    monkeypatch.setattr(nb, "_multiplied", counted)
    found = nb.pruned(asked, train, 5, rows=20)
    assert found.count() == 200 and found.agg(nb.F.min("sim")).first()[0] == 1.0
    assert sum(cells) <= 2 * 40 < 40 * 20 / 5


def test_one_query_is_repeated_not_its_documents(spark, monkeypatch):
    """A heavy term with a single query copies the query once per part of the documents."""
    monkeypatch.setattr(nb, "ROWS_PER_SALT", 5)
    t, train = random_table(spark, 160, 30, 1)
    q, queries = random_table(spark, 8, 30, 2, label=False, first_id=1000)
    one = collected(nb.nearest(queries.filter("doc_id = 1000"), train, 9, plan="join"), "sim", 1000)
    assert one[0] == brute(q, t, 9, "cosine")[0]


def test_same_answer_whatever_the_number_of_pairs(spark):
    """Filling and distances over several representations never depend on the data's size."""
    for hot in (True, False):
        _, train = random_table(spark, 40, 30, 1, hot=hot)
        _, queries = random_table(spark, 10, 30, 2, label=False, first_id=1000, hot=hot)
        two = [d.withColumn("rep", nb.F.lit("a")) for d in (queries, train)]
        assert nb.nearest(*two, 3, by=["rep"]).count() == 30
        assert nb.nearest(*two, 3, metric="euclidean", by=["rep"]).count() == 30
        with pytest.raises(ValueError):
            nb.nearest(*two, 3, by=["rep"], plan="join")


def test_one_hot_term_in_every_row_uses_blocks(spark):
    _, train = random_table(spark, 120, 10, 1)
    _, queries = random_table(spark, 60, 10, 2, label=False, first_id=1000)
    assert nb.choose_plan(queries, train) == "blocks"


def test_several_query_and_train_blocks(spark, monkeypatch):
    t, train = random_table(spark, 160, 30, 3)
    q, queries = random_table(spark, 40, 30, 4, label=False, first_id=1000)
    monkeypatch.setattr(nb, "QUERY_BLOCK_ROWS", 9)
    monkeypatch.setattr(nb, "TRAIN_BLOCK_ROWS", 25)
    assert collected(nb.blocked(queries, train, 7), "sim", 1000) == brute(q, t, 7, "cosine")


def test_without_fill_only_overlapping_documents(spark):
    _, train = random_table(spark, 80, 60, 1, hot=False)
    _, queries = random_table(spark, 20, 60, 2, label=False, first_id=1000, hot=False)
    rows = {}
    for plan in ("join", "blocks"):
        found = nb.nearest(queries, train, 60, fill=False, plan=plan)
        rows[plan] = sorted((r["query_id"], r["train_id"], r["sim"], r["rank"]) for r in found.collect())
    assert rows["join"] == rows["blocks"]
    assert all(r[2] > 0 for r in rows["join"])


def test_dense_cosine_with_negative_similarities(spark):
    rng = np.random.default_rng(0)
    t, q = rng.standard_normal((150, 8)), rng.standard_normal((12, 8))
    t /= np.linalg.norm(t, axis=1, keepdims=True)
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    train = spark.createDataFrame([(i, i % 3, r.tolist()) for i, r in enumerate(t)], "doc_id bigint, label int, vec array<double>")
    queries = spark.createDataFrame([(1000 + i, r.tolist()) for i, r in enumerate(q)], "doc_id bigint, vec array<double>")
    assert collected(nb.nearest(queries, train, 149), "sim", 1000) == brute(q, t, 149, "cosine")
    with pytest.raises(ValueError):
        nb.nearest(queries, train, 3, metric="euclidean")


def test_both_sides_from_one_table(spark):
    _, train = random_table(spark, 40, 20, 9)
    found = nb.nearest(train.filter("doc_id < 10").drop("label"), train, 1, plan="blocks")
    best = {r["query_id"]: r["train_id"] for r in found.collect()}
    assert best[0] == 0 and best[5] == 3 and best[7] == 0


def test_micro_similarities(micro):
    found = nb.nearest(micro.queries, micro.train, 5, plan="join")
    sims = {r["train_id"]: r["sim"] for r in found.filter("query_id = 100").collect()}
    assert sims == {0: 0.816497, 1: 0.5, 4: 0.427505, 2: 0.0, 3: 0.0}


@pytest.mark.parametrize("plan", ["join", "blocks"])
def test_micro_votes(micro, plan):
    found = nb.nearest(micro.queries, micro.train, 3, plan=plan)
    scores = votes.class_scores(found, 2.0).collect()
    got = {(r["query_id"], r["label"]): round(r["score"], 5) for r in scores if r["score"]}
    assert got == {(100, 1): 0.91667, (100, 4): 0.18276, (101, 2): 0.66667}

    def predicted(voting):
        model = NeighbourClassifier(3, voting=voting, sim_power=2.0, plan=plan).fit(micro.train)
        return {r["query_id"]: r["pred"] for r in model.predict(micro.queries).collect()}

    assert predicted("weighted") == {100: 1, 101: 2, 102: 1}
    assert predicted("majority") == {100: 1, 101: 1, 102: 1}


def test_ties_go_to_lowest_label_or_nearest_class(spark):
    rows = [(1, 10, 3, 0.5, 1), (1, 11, 2, 0.5, 2)]
    found = spark.createDataFrame(rows, "query_id bigint, train_id bigint, label int, sim double, rank int")
    assert votes.decide(votes.class_scores(found, 1.0)).first()["pred"] == 2
    assert votes.decide(votes.nearest_first_scores(found)).first()["pred"] == 3


def test_clamping_of_negative_similarities(spark):
    found = spark.createDataFrame([(1, 1, 1, -0.5, 1)], "query_id bigint, train_id bigint, label int, sim double, rank int")
    score = lambda power, clamp: votes.class_scores(found, power, clamp).first()["score"]
    assert score(1.0, None) == -0.5 and score(1.0, True) == 0.0 and score(2.0, None) == 0.0


def test_inverse_distance_weight(spark):
    found = spark.createDataFrame([(1, 1, 1, 4.0, 1)], "query_id bigint, train_id bigint, label int, dist2 double, rank int")
    assert votes.class_scores(found, 2.0).first()["score"] == pytest.approx(0.25)


def test_feedback_moves_queries_towards_neighbours(micro):
    def rows(expanded):
        return {r["doc_id"]: {e["term_id"]: e["w"] for e in r["vec"]} for r in expanded.collect()}

    train = {r["doc_id"]: {e["term_id"]: e["w"] for e in r["vec"]} for r in micro.train.collect()}
    asked = {r["doc_id"]: {e["term_id"]: e["w"] for e in r["vec"]} for r in micro.queries.collect()}

    def blend(parts):
        out = {}
        for weight, vector in parts:
            for term, w in vector.items():
                out[term] = out.get(term, 0.0) + weight * w
        norm = sum(w * w for w in out.values()) ** 0.5 or 1.0
        return {t: w / norm for t, w in out.items()}

    got = rows(feedback.expand_uniform(micro.queries, micro.train, 2, 0.8))
    assert got[100] == pytest.approx(blend([(0.8, asked[100]), (0.1, train[0]), (0.1, train[1])]))
    assert got[101] == pytest.approx(blend([(0.8, asked[101]), (0.1, train[2]), (0.1, train[0])]))
    assert got[102] == pytest.approx(blend([(0.1, train[0]), (0.1, train[1])]))
    got = rows(feedback.expand_weighted(micro.queries, micro.train, 2))
    total = 0.816497 + 0.5
    want = blend([(0.9, asked[100]), (0.1 * 0.816497 / total, train[0]), (0.05 / total, train[1])])
    assert got[100] == pytest.approx(want)
    assert got[102] == {}


def test_guards(micro):
    with pytest.raises(ValueError):
        NeighbourClassifier(0)
    with pytest.raises(ValueError):
        NeighbourClassifier(1, metric="manhattan")
    with pytest.raises(RuntimeError):
        NeighbourClassifier(1).predict(micro.queries)
    with pytest.raises(RuntimeError):
        EnsembleClassifier().predict({"a": micro.queries})
    dense = micro.train.select("doc_id", "label", F.array(F.lit(1.0)).alias("vec"))
    with pytest.raises(ValueError):
        NeighbourClassifier(1, metric="euclidean").fit(dense)


def test_plans_stay_distributed(micro):
    def text(frame):
        return frame._jdf.queryExecution().toString()

    pairs = text(nb.dot_products(micro.queries, micro.train))
    assert "CartesianProduct" not in pairs and "NestedLoop" not in pairs
    best = text(nb.top_k(nb.dot_products(micro.queries, micro.train).withColumnRenamed("dot", "sim"), 3))
    assert "WindowGroupLimit" in best


def test_tokenising_a_wide_input_does_not_shuffle(spark, tmp_path):
    from nearlex.functions.text import counted
    from nearlex.operators import bags as bg

    texts = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"))
    texts.repartition(16).write.parquet(str(tmp_path / "wide"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        tokens = bg.tokenised(spark.read.parquet(str(tmp_path / "wide")), bg.rich_analyzer(3))
        plan = tokens.select(counted(F.col("tokens")))._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert "Exchange" not in plan


@pytest.mark.parametrize("metric, value", [("cosine", "sim"), ("euclidean", "dist2")])
@pytest.mark.parametrize("k", [5, 500])
def test_scan_equals_brute_force(spark, metric, value, k, monkeypatch):
    """Many parts a task, groups told apart, documents left where they are."""
    monkeypatch.setattr(nb, "SCAN_ROWS", 9)
    t, train = random_table(spark, 160, 30, 1)
    q, queries = random_table(spark, 23, 30, 2, label=False, first_id=1000, hot=False)
    want = brute(q, t, k, metric)
    found = nb.nearest(queries, train, k, metric=metric)
    assert "FlatMapCoGroups" not in found._jdf.queryExecution().executedPlan().toString()
    assert collected(found, value, 1000) == want
    two = [d.withColumn("rep", F.explode(F.array(F.lit("a"), F.lit("b")))) for d in (queries, train)]
    both = nb.nearest(*two, k, metric=metric, by=["rep"])
    for rep in ("a", "b"):
        assert collected(both.filter(F.col("rep") == rep), value, 1000) == want


def test_scan_is_for_few_queries(spark, monkeypatch):
    _, train = random_table(spark, 80, 30, 1)
    _, queries = random_table(spark, 23, 30, 2, label=False, first_id=1000)
    want = collected(nb.nearest(queries, train, 5, plan="scan", fill=False), "sim", 1000)
    for name in ("SCAN_QUERIES", "SCAN_BYTES", "SCAN_FOUND"):
        with monkeypatch.context() as m:
            m.setattr(nb, name, 10)
            assert collected(nb.nearest(queries, train, 5, fill=False), "sim", 1000) == want
            with pytest.raises(ValueError):
                nb.nearest(queries, train, 5, plan="scan")


def test_blocks_are_counted_within_a_representation(spark, monkeypatch):
    """Representations do not meet, so their number does not multiply the copies of a row; tiles give the same rows."""
    rng = np.random.default_rng(8)
    rows = [
        (rep, i, i % 3, [(int(t), float(rng.random()) + 0.1) for t in np.unique(rng.integers(0, 40, 6))])
        for rep in ("a", "b", "c") for i in range(120)
    ]
    both = spark.createDataFrame(rows, "rep string, doc_id bigint, label int, vec array<struct<term_id:int,w:double>>")
    asked, docs = both.filter("doc_id < 40").drop("label"), both
    want = sorted(map(tuple, nb.nearest(asked, docs, 3, fill=False, by=["rep"], plan="join").select("rep", "query_id", "train_id", "sim", "rank").collect()))
    monkeypatch.setattr(nb, "QUERY_BLOCK_ROWS", 20)
    monkeypatch.setattr(nb, "TRAIN_BLOCK_ROWS", 60)
    monkeypatch.setattr(nb, "TILE_ROWS", 7)
    monkeypatch.setattr(nb, "parallelism", lambda session: 1)
    assert nb._block_counts(asked, docs, ["rep"])[:4] == (120, 360, 2, 2)
    got = nb.nearest(asked, docs, 3, fill=False, by=["rep"], plan="blocks").select("rep", "query_id", "train_id", "sim", "rank")
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("share", [0.0, 0.05, 2.0])
def test_tiles_give_the_best_of_the_block_once(spark, monkeypatch, metric, share):
    """Whether terms are multiplied as a matrix or pair by pair, k rows a query leave a block of many tiles."""
    from nearlex.operators import kernels as kn

    monkeypatch.setattr(kn, "_DENSE_SHARE", share)
    monkeypatch.setattr(kn, "_FORMED_PAIRS", 50)
    monkeypatch.setattr(kn, "_DENSE_CELLS", 400)
    q = random_table(spark, 30, 12, 5, label=False)[1].withColumnRenamed("doc_id", "query_id").toArrow()
    t = random_table(spark, 90, 12, 6, first_id=1000)[1].withColumnRenamed("doc_id", "train_id").toArrow().sort_by("train_id")
    whole = kn.best_in_block(q, t, 7, metric, False, 6)
    rows, cols, values = kn.best_in_tiles(q, t, 7, metric, False, 6, 16)
    assert len(rows) == 30 * 7 and np.array_equal(rows, whole[0]) and np.array_equal(cols, whole[1])
    assert np.allclose(values, whole[2], atol=1e-12)
    terms = lambda table: [{e["term_id"]: e["w"] for e in v} for v in table.column("vec").to_pylist()]
    left, right = terms(q)[rows[0]], terms(t)[cols[0]]
    dot = sum(w * right.get(i, 0.0) for i, w in left.items())
    square = lambda v: sum(w * w for w in v.values())
    assert values[0] == pytest.approx(dot if metric == "cosine" else square(left) + square(right) - 2 * dot, abs=1e-9)


def test_blocks_are_as_large_as_a_task_holds(spark, monkeypatch):
    """A document is copied once for each block of queries: many queries of few entries are one block, those of many are not."""
    monkeypatch.setattr(nb, "parallelism", lambda session: 1)
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.expr("array(named_struct('term_id', cast(id % 50 as int), 'w', 1.0D))").alias("vec"))
    n_q, n_t, q_blocks, t_blocks, _ = nb._block_counts(rows.filter("doc_id < 20000"), rows, k=11)
    assert n_q * t_blocks + n_t * q_blocks <= 4 * (n_q + n_t)
    assert nb._block_counts(rows, rows, k=100)[2] == 4
    monkeypatch.setattr(nb, "QUERY_BLOCK_ENTRIES", 5_000)
    assert nb._block_counts(rows, rows)[2] == 8
    # Small tables are cut until all slots have work.
    monkeypatch.setattr(nb, "parallelism", lambda session: 50)
    few = rows.filter("doc_id < 4000")
    _, _, q_blocks, t_blocks, _ = nb._block_counts(few, few)
    assert q_blocks * t_blocks >= 4 * 50


def test_large_blocks_give_the_rows_of_small_ones(spark, monkeypatch):
    t, train = random_table(spark, 400, 30, 3)
    q, queries = random_table(spark, 300, 30, 4, label=False, first_id=1000)
    for k in (7, 60):
        want = brute(q, t, k, "cosine")
        assert collected(nb.blocked(queries, train, k), "sim", 1000) == want
        monkeypatch.setattr(nb, "QUERY_BLOCK_FOUND", 900)
        assert collected(nb.blocked(queries, train, k), "sim", 1000) == want
