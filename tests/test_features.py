import numpy as np
import pytest
from pyspark.sql import functions as F

from nearlex.operators import bags as bg, lsi, selection, vectors as vx, vocabulary
from nearlex.operators.ranking import head, ranked
from nearlex.operators.vocabulary import fit_vocabulary


def weights(vectors, vocab, doc):
    rows = vx.named_entries(vectors, vocab).filter(F.col("doc_id") == doc).collect()
    return {r["term"]: round(r["w"], 6) for r in rows}


def test_corpus_statistics(micro):
    assert micro.n == 5 and micro.avgdl == pytest.approx(2.8)


def test_vocabulary_order_and_idf(micro):
    rows = micro.vocab.orderBy("term_id").collect()
    assert [r["term"] for r in rows] == ["market", "oil", "price", "rise", "bank", "game", "phone", "team", "win"]
    assert {round(r["idf"], 6) for r in rows} == {0.875469, 1.386294}
    assert {round(r["idf"], 6) for r in micro.smooth.collect()} == {1.693147, 2.098612}


def test_bm25_and_sublinear_rows(micro):
    assert weights(micro.train, micro.vocab, 4) == {"market": 0.425318, "bank": 0.673486, "rise": 0.604584}
    assert weights(micro.sublinear, micro.smooth, 4) == {"market": 0.43021, "bank": 0.533235, "rise": 0.728409}


def test_unknown_terms_leave_an_empty_vector(micro):
    rows = {r["doc_id"]: len(r["vec"]) for r in micro.queries.collect()}
    assert rows == {100: 2, 101: 2, 102: 0}


def test_min_df_max_df_and_caps(micro):
    assert fit_vocabulary(micro.bag, 5, min_df=2).count() == 4
    assert fit_vocabulary(micro.bag, 5, min_df=1, max_df=0.3).count() == 5
    assert [r["term"] for r in fit_vocabulary(micro.bag, 5, min_df=1, max_terms=1, cap_by="total").collect()] == ["rise"]
    with pytest.raises(ValueError):
        fit_vocabulary(micro.bag, 5, idf="other")


@pytest.mark.parametrize("cap_by", ["df", "total"])
def test_capped_vocabulary_does_not_shuffle_rare_terms(spark, monkeypatch, cap_by):
    """Same vocabulary, ties included, as counting every term; few buckets, most of them shared, as well as many."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join([f"w{int(j)}" for j in rng.zipf(1.3, 60) % 5000] + [f"once{i}x{j}" for j in range(20)])) for i in range(400)]
    bag = bg.bags(bg.tokenised(spark.createDataFrame(rows, "doc_id bigint, text string"), bg.rich_analyzer(1, normaliser=None)))
    fitted = lambda cap: [tuple(r) for r in fit_vocabulary(bag, 400, max_df=0.9, max_terms=cap, cap_by=cap_by).orderBy("term_id").collect()]
    plain = {cap: fitted(cap) for cap in (25, 150, 4_000)}
    monkeypatch.setattr(vocabulary, "BUCKETED_ENTRIES", 0)
    monkeypatch.setattr(vocabulary, "CHUNK", 64)
    shuffled, counts_in = [], vocabulary._counts_in
    monkeypatch.setattr(vocabulary, "_counts_in", lambda *args: shuffled.append((got := counts_in(*args)).count()) or got)
    for buckets in (1 << 8, 1 << 14):
        monkeypatch.setattr(vocabulary, "BUCKETS", buckets)
        assert {cap: fitted(cap) for cap in plain} == plain
    assert bg.document_frequencies(bag).count() > 8_000 and 0 < min(shuffled) < 200


def test_chi2_scores_and_selection(micro):
    scores = selection.chi2_scores(micro.train).join(micro.vocab, "term_id")
    got = {r["term"]: round(r["chi2"], 6) for r in scores.collect()}
    assert got == {
        "phone": 3.38205, "bank": 2.693943, "game": 2.309401, "team": 2.309401, "win": 2.309401,
        "oil": 1.926686, "rise": 1.069411, "price": 0.921327, "market": 0.770109,
    }
    train, asked = selection.select_features(micro.train, micro.vocab, 3, micro.queries)
    kept = {r["term"] for r in vx.named_entries(train, micro.vocab).collect()}
    assert kept == {"phone", "bank", "game"}
    assert train.count() == 5 and asked.count() == 3
    for row in train.collect():
        norm = sum(e["w"] ** 2 for e in row["vec"])
        assert norm == pytest.approx(1.0) or not row["vec"]
    everything, = selection.select_features(micro.train, micro.vocab, 999)
    assert vx.entries(everything).count() == vx.entries(micro.train).count()


def test_empty_document_counts_and_survives(spark):
    docs = spark.createDataFrame([(1, 1, ""), (2, 1, "alpha beta")], "doc_id bigint, label int, text string")
    bag = bg.bags(bg.tokenised(docs, bg.rich_analyzer(1)))
    assert bg.corpus_stats(bag) == (2, 1.0)
    vocab = fit_vocabulary(bag, 2, min_df=1)
    vectors = vx.weigh(bag, vocab, vx.bm25_weight(1.0))
    assert {r["doc_id"]: len(r["vec"]) for r in vectors.collect()} == {1: 0, 2: 2}


def test_variants_agree_with_single_weighings(micro):
    both = vx.weigh_variants(micro.bag, micro.vocab, {"a": vx.bm25_weight(micro.avgdl), "b": vx.bm25_weight(micro.avgdl, 2.0, 1.0)})
    single = vx.weigh(micro.bag, micro.vocab, vx.bm25_weight(micro.avgdl, 2.0, 1.0))
    assert both.count() == 10
    left = {r["doc_id"]: r["vec"] for r in both.filter("rep = 'b'").collect()}
    assert left == {r["doc_id"]: r["vec"] for r in single.collect()}


def test_ranked_is_a_global_order(spark):
    frame = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("x"), "id").repartition(7)
    rows = ranked(frame, [F.col("x"), F.col("id")]).collect()
    assert [r["x"] for r in sorted(rows, key=lambda r: r["rank"])] == sorted(r["x"] for r in rows)
    assert sorted(r["rank"] for r in rows) == list(range(1000))
    assert [r["id"] for r in head(frame, 3, "id").orderBy("id").collect()] == [0, 1, 2]


def _random_vectors(spark, rows, terms, seed):
    rng = np.random.default_rng(seed)
    dense = np.where(rng.random((rows, terms)) < 0.3, rng.random((rows, terms)), 0.0)
    dense[0] = 0
    data = [(i, [(int(j), float(dense[i, j])) for j in np.flatnonzero(dense[i])]) for i in range(rows)]
    return dense, spark.createDataFrame(data, "doc_id bigint, vec array<struct<term_id:int,w:double>>").repartition(3)


def _matrix(fitted, terms):
    """The components as terms by components."""
    out = np.zeros((terms, fitted.rank))
    for r in fitted.entries().collect():
        out[r["term_id"], r["component"]] = r["value"]
    return out


def test_svd_against_numpy(spark, monkeypatch):
    # Several blocks of rows and terms, and two levels of sums.
    monkeypatch.setattr(lsi, "BLOCK_ROWS", 7)
    monkeypatch.setattr(lsi, "FAN_IN", 3)
    monkeypatch.setattr(lsi, "BASIS_BYTES", 1)
    dense, vectors = _random_vectors(spark, 60, 45, 5)
    fitted = lsi.fit_components(vectors, 4, n_iter=8)
    matrix = _matrix(fitted, 45)
    exact = np.linalg.svd(dense, compute_uv=False)[:4]
    assert fitted.terms == 16 and fitted.basis.count() == 3
    assert np.allclose(fitted.singular_values, exact, atol=1e-4)
    assert np.allclose(matrix.T @ matrix, np.eye(4), atol=1e-12)
    residual = np.linalg.norm(dense.T @ (dense @ matrix) - matrix * fitted.singular_values**2, axis=0)
    assert (residual / fitted.singular_values**2 < 0.05).all()
    assert (matrix[np.abs(matrix).argmax(0), range(4)] > 0).all()
    raw = lsi.project(vectors, fitted, normalise=False)
    got = np.array([r["vec"] for r in raw.orderBy("doc_id").collect()])
    assert np.allclose(got, dense @ matrix)
    share = lsi.explained_variance(vectors, raw).first()[0]
    assert share == pytest.approx((dense @ matrix).var(axis=0).sum() / dense.var(axis=0).sum())
    unit = lsi.project(vectors, fitted).filter("doc_id = 0").first()["vec"]
    assert unit == [0.0] * 4


def test_few_large_blocks_of_rows_move_the_basis(spark, monkeypatch):
    """A basis row travels once for each block of a task's size, not of 500,000 entries; slices of columns give the same components."""
    rng = np.random.default_rng(3)
    rows, terms = 3_000, 900
    data = [(i, [(int(j), float(rng.random())) for j in np.unique(rng.integers(0, terms, 260))]) for i in range(rows)]
    vectors = spark.createDataFrame(data, "doc_id bigint, vec array<struct<term_id:int,w:double>>").repartition(4).localCheckpoint()
    packed = lsi.pack(vectors, [], 16)
    assert packed.select("part").distinct().count() == 1
    asked = lsi._asked_rows(packed, lsi._random(packed, 6, 16, 1), 6, 3)
    assert asked.agg(F.sum(F.octet_length("q"))).first()[0] == terms * 6 * 8
    whole = lsi.fit_components(vectors, 4, n_iter=2)
    monkeypatch.setattr(lsi, "parallelism", lambda session: 1)
    assert np.allclose(_matrix(whole, terms), _matrix(lsi.fit_components(vectors, 4, n_iter=2), terms), atol=1e-9)


def test_no_block_of_the_basis_reaches_the_driver(spark, monkeypatch):
    """Only columns-by-columns sums and one sign a component are collected, whatever the vocabulary."""
    rng = np.random.default_rng(9)
    data = [(i, [(int(t), 1.0) for t in np.unique(rng.integers(0, 2_000_000, 30))]) for i in range(40)]
    vectors = spark.createDataFrame(data, "doc_id bigint, vec array<struct<term_id:int,w:double>>")
    sizes, frame = [], type(vectors)
    to_arrow = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: sizes.append((got := to_arrow(df)).nbytes) or got)
    fitted = lsi.fit_components(vectors, 3, n_iter=2)
    assert fitted.rank == 3 and sizes and max(sizes) < 8 * lsi.GROUPS * (13 * 13 + 8)
    plan = fitted.basis._jdf.queryExecution().toString()
    assert "Broadcast" not in plan


def test_projection_is_the_sql_over_the_components(spark):
    """Projected values, unit rows and the explained share against DuckDB, given the components."""
    duckdb = pytest.importorskip("duckdb")
    _, vectors = _random_vectors(spark, 50, 30, 3)
    fitted = lsi.fit_components(vectors, 5, n_iter=3)
    con = duckdb.connect()
    con.register("v", fitted.entries().toPandas())
    con.register("x", vx.entries(vectors).toPandas())
    con.register("docs", vectors.select("doc_id").toPandas())
    con.execute(
        "CREATE TABLE y AS SELECT doc_id, component, coalesce(s, 0) AS s"
        " FROM (SELECT doc_id, unnest(range(5))::INT AS component FROM docs)"
        " LEFT JOIN (SELECT doc_id, component, sum(w * value) AS s FROM x JOIN v USING (term_id) GROUP BY ALL) USING (doc_id, component)"
    )
    want = con.execute(
        "SELECT doc_id, component, round(s / coalesce(nullif(sqrt(sum(s * s) OVER (PARTITION BY doc_id)), 0), 1), 9) FROM y"
    ).fetchall()
    unit = lsi.project(vectors, fitted).select("doc_id", F.posexplode("vec").alias("c", "s"))
    assert sorted(map(tuple, unit.select("doc_id", "c", F.round("s", 9)).collect())) == sorted(want)
    share = con.execute(
        "SELECT (SELECT sum(p) FROM (SELECT var_pop(s) AS p FROM y GROUP BY component)) / sum(a - b * b) FROM"
        " (SELECT sum(w * w) / 50 AS a, sum(w) / 50 AS b FROM x GROUP BY term_id)"
    ).fetchone()[0]
    assert lsi.explained_variance(vectors, lsi.project(vectors, fitted, False)).first()[0] == pytest.approx(share)


def test_equal_and_missing_ids_are_projected_apart(spark):
    rows = [(None, [(0, 1.0)]), (None, [(1, 1.0)]), (7, [(0, 1.0), (2, 1.0)]), (7, [(1, 2.0)]), (8, []), (9, [(99, 1.0)])]
    vectors = spark.createDataFrame(rows, "doc_id bigint, vec array<struct<term_id:int,w:double>>")
    fitted = lsi.fit_components(vectors.filter("doc_id is null or doc_id < 9"), 2)
    assert sorted(str(r["doc_id"]) for r in lsi.project(vectors, fitted).collect()) == sorted(["None", "None", "7", "7", "8", "9"])


def test_component_count_is_cut_to_the_data(spark):
    _, vectors = _random_vectors(spark, 4, 6, 1)
    assert lsi.fit_components(vectors, 50).rank == 3


def test_weighting_and_selection_stay_in_the_row(micro):
    """No exchange after the bags while the vocabulary passes the size check; the join gives the same rows."""
    from nearlex.functions.expressions import unit_vector  # noqa: F401
    from nearlex.operators import selection, vectors as vx

    known = micro.vocab.select("term", "term_id", "idf").toArrow()
    found = vx.looked_up(micro.bag, known, ["doc_id", "label"])
    plan = found.select("doc_id", vx._weighed_in_row(found, ["doc_id"], vx.bm25_weight(2.8)))._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    kept = selection._kept_in_row(micro.train, micro.vocab.limit(3).select("term_id").toArrow(), ["doc_id", "label"])
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


ODD_IDS = [
    (None, 1, "oil price rise rise"), (None, 1, "game team"), (7, 2, "oil oil market"), (7, 2, "bank"), (7, 2, "oil oil market"),
    (8, 3, ""), (9, 3, "zebra"), (None, None, ""), (10, 4, "oil " * 40),
]


@pytest.fixture(scope="module")
def odd_bag(spark):
    from nearlex.functions.text import split_words

    docs = spark.createDataFrame(ODD_IDS, "doc_id bigint, label int, text string")
    return bg.tokenised(docs, split_words), bg.bags(bg.tokenised(docs, split_words))


def _rows(frame):
    """All rows as text, weights rounded: comparable with null and repeated ids."""
    def plain(value):
        if isinstance(value, list):
            return [plain(v) for v in value]
        if isinstance(value, tuple):
            return tuple(plain(v) for v in value)
        return round(value, 9) if isinstance(value, float) else value

    return sorted(repr(plain(tuple(r[c] for c in sorted(frame.columns)))) for r in frame.collect())


def test_size_of_a_table_changes_no_row(spark, micro, odd_bag, monkeypatch):
    """Lookups inside the row and joins give the same rows, with null and repeated ids and heavy terms."""
    from nearlex.operators import rowjoin

    monkeypatch.setattr(rowjoin, "KEY_ROWS", 2)
    tokens, bag = odd_bag
    weight = vx.bm25_weight(2.8)
    inside, joined = (vx.weigh(bag, micro.vocab, weight, limit=limit) for limit in (1 << 20, 0))
    assert inside.count() == len(ODD_IDS) and _rows(inside) == _rows(joined)
    assert inside.schema["vec"].dataType.simpleString() == joined.schema["vec"].dataType.simpleString()
    variants = {"a": weight, "b": vx.sublinear_weight()}
    assert _rows(vx.weigh_variants(bag, micro.vocab, variants)) == _rows(vx.weigh_variants(bag, micro.vocab, variants, limit=0))
    chosen = micro.vocab.orderBy("term_id").limit(4)
    kept = [selection.keep_terms(inside, chosen, limit=limit) for limit in (1 << 20, 0)]
    assert kept[0].count() == len(ODD_IDS) and _rows(kept[0]) == _rows(kept[1])
    forms = spark.createDataFrame([("oil", "petrol"), ("oil", "oel"), ("game", "play"), (None, "x")], "token string, lemma string")
    spelled = [bg.normalised_by_table(tokens, forms, limit=limit) for limit in (1 << 20, 0)]
    assert spelled[0].count() == len(ODD_IDS) and _rows(spelled[0]) == _rows(spelled[1])
    assert any("oel" in r for r in _rows(spelled[1])) and not any("petrol" in r for r in _rows(spelled[1]))


def test_heavy_keys_are_few_and_dealt(spark):
    from nearlex.operators.rowjoin import heavy_keys

    keys = spark.range(1000).select(F.when(F.col("id") < 400, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("_key"))
    assert [tuple(r) for r in heavy_keys(keys, 100).collect()] == [("hot", 4)]


def test_nth_value_by_counting(spark):
    from nearlex.operators.ranking import largest, nth_smallest

    rng = np.random.default_rng(8)
    values = np.concatenate([rng.integers(-(2**62), 2**62, 300), rng.integers(-5, 5, 300), [2**63 - 1, -(2**63)]]).tolist()
    frame = spark.createDataFrame([(int(v),) for v in values], "x bigint").repartition(5)
    for n in (0, 1, 150, 300, 450, 601):
        want = sorted(values)[n]
        assert nth_smallest(frame, F.col("x"), n) == (want, sum(v < want for v in values))
    assert nth_smallest(frame, F.col("x"), 602) is None
    for n in (1, 7, 301, 602, 900):
        bound = sorted(values)[-min(n, len(values))]
        assert sorted(r["x"] for r in largest(frame, F.col("x"), n).collect()) == sorted(v for v in values if v >= bound)
    assert largest(frame, F.col("x"), 0).count() == 0


def test_caps_sort_only_what_stays(spark, monkeypatch):
    """The whole vocabulary and all scores are counted, never sorted."""
    from nearlex.operators import vocabulary

    sorted_rows = []
    for module in (vocabulary, selection):
        inner = module.ranked
        monkeypatch.setattr(module, "ranked", lambda df, *a, f=inner: sorted_rows.append(df.count()) or f(df, *a))
    rows = [(i, [(f"t{j:03d}", 1) for j in range(100) if j <= i]) for i in range(100)]
    bag = spark.createDataFrame([(i, len(t), t) for i, t in rows], "doc_id bigint, dl int, terms array<struct<term:string,tf:bigint>>")
    vocab = fit_vocabulary(bag, 100, min_df=1, max_terms=7)
    assert [r["term"] for r in vocab.orderBy("term_id").collect()] == [f"t{j:03d}" for j in range(7)]
    scores = spark.range(100).select(F.col("id").cast("int").alias("term_id"), (F.col("id") / 10.0).alias("chi2"))
    names = spark.range(100).select(F.col("id").cast("int").alias("term_id"), F.concat(F.lit("w"), "id").alias("term"))
    assert sorted(r["term_id"] for r in selection.best_terms(scores, names, 3).collect()) == [97, 98, 99]
    assert sorted_rows == [7, 3]


def test_first_rows_without_sorting_them(spark):
    from nearlex.operators.ranking import before_rank, head

    frame = spark.createDataFrame([(i, "t" * i) for i in (5, 3, 9, 1)], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in head(frame, 2, "doc_id").collect()) == [1, 3]
    assert head(frame, 9, "doc_id").count() == 4 and head(frame, 0, "doc_id").count() == 0
    marked = frame.withColumn("first", before_rank(frame, [F.col("doc_id")], 2))
    assert "Exchange" not in marked._jdf.queryExecution().executedPlan().toString()


def test_large_tables_are_asked_once_a_block(spark, micro, odd_bag, monkeypatch):
    """Blocks of few elements give the rows of a lookup inside the row; each asks for a key once."""
    from nearlex.operators import rowjoin

    monkeypatch.setattr(rowjoin, "BLOCK_ELEMENTS", 5)
    monkeypatch.setattr(rowjoin, "PIECE_ELEMENTS", 2)
    asked = []
    staged = rowjoin.stage
    monkeypatch.setattr(rowjoin, "stage", lambda df, name: asked.append(out := staged(df, name)) or out)
    _, bag = odd_bag
    weight = vx.bm25_weight(2.8)
    inside, joined = (vx.weigh(bag, micro.vocab, weight, limit=limit) for limit in (1 << 20, 0))
    assert _rows(inside) == _rows(joined)
    named = [vx.named_entries(inside, micro.vocab, limit=limit) for limit in (1 << 20, 0)]
    assert _rows(named[0]) == _rows(named[1]) and named[0].count() > 0
    keys = asked[0].filter("key is not null")
    assert asked[0].select("part").distinct().count() > 1
    assert keys.count() == keys.select("part", "key").distinct().count()
    assert vx.weigh(bag.limit(0), micro.vocab, weight, limit=0).count() == 0
    assert _rows(vx.weigh(bag, micro.vocab.limit(0), weight, limit=0)) == _rows(vx.weigh(bag, micro.vocab.limit(0), weight))


def test_formulas_in_the_row_equal_columns(spark, micro):
    """Vectors leave the Arrow step weighed: no higher-order function runs row by row after it."""
    known = micro.vocab.select("term", "term_id", "idf").toArrow()
    for weight in (vx.bm25_weight(2.8, 0.9, 0.3), vx.sublinear_weight(), vx.tfidf_weight(), vx.tfidf_weight(True)):
        found = vx.looked_up(micro.bag, known, ["doc_id", "label"])
        want = found.select("doc_id", "label", vx._weighed_in_row(found, ["doc_id"], weight))
        got = vx.looked_up(micro.bag, known, ["doc_id", "label"], [weight])
        assert "transform(" not in got._jdf.queryExecution().executedPlan().toString()
        assert _rows(got.withColumnRenamed("vec0", "vec")) == _rows(want)
    kept = selection._kept_in_row(micro.train, micro.vocab.limit(3).select("term_id").toArrow(), ["doc_id", "label"])
    assert "transform(" not in kept._jdf.queryExecution().executedPlan().toString()


def test_a_block_of_sorted_terms_is_small():
    """Codes of sorted terms ascend, so a packed block holds about two bytes an entry."""
    import numpy as np
    import pyarrow as pa

    from nearlex.operators import rowjoin

    rng = np.random.default_rng(3)
    codes = np.concatenate([np.sort(rng.choice(100_000, 250, replace=False)) for _ in range(80)]).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array([f"t{c:06d}" for c in codes]), pa.array(np.ones(len(codes), np.int64))], names=["term", "tf"])
    rows = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(80)), pa.ListArray.from_arrays(pa.array(np.arange(0, 80 * 250 + 1, 250), pa.int32()), entries)], names=["doc_id", "terms"]
    )
    data = rowjoin._coded(rows, ["doc_id"], "terms", "term", pa.array(codes))
    assert len(data) < 4 * len(codes)
    held = pa.ipc.open_stream(data).read_all().column("_items").combine_chunks().flatten()
    assert np.array_equal(np.cumsum(held.field("_step")), codes)


def test_formulas_on_the_same_counts_count_terms_once(spark, monkeypatch):
    from dataclasses import replace

    from nearlex.plans import presets as ps

    docs = spark.createDataFrame([(i, i % 3, f"oil price {i % 5} rises game{i % 4}") for i in range(40)], "doc_id bigint, label int, text string")
    plain = {n: ps.build(s, docs).vocab for n, s in ps.ENSEMBLE.items() if n != "char"}
    calls, counted = [], vocabulary.most_counted
    monkeypatch.setattr(vocabulary, "most_counted", lambda *a: calls.append(1) or counted(*a))
    held: dict = {}
    shared = {n: ps.build(ps.ENSEMBLE[n], docs, held=held).vocab for n in plain}
    assert len(calls) == 1
    assert all(sorted(shared[n].collect()) == sorted(plain[n].collect()) for n in plain)
    # Other bounds are counted for themselves.
    ps.build(replace(ps.ENSEMBLE["bm25"], max_terms=3), docs, held=held)
    assert len(calls) == 2


def test_readers_hold_few_rows_of_long_arrays(spark, micro):
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    import time

    from nearlex.session import remove_stage, ship_package, stage

    ship_package(spark)
    rows = spark.range(50_000).groupBy((F.col("id") % 1_000).alias("k")).count()
    before = _shuffle_files(spark)
    staged = stage(rows, "counted")
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    # Run again it is computed again.
    assert sorted(rows.collect()) == sorted(rows.collect()) == sorted(staged.collect())
    remove_stage(staged)
    with pytest.raises(Exception):
        staged.collect()
