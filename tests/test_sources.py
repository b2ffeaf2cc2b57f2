import pytest

from nearlex.plans import classify as cl, presets as ps
from nearlex.sources import lines, predictions


def rows(frame):
    return [tuple(r) for r in frame.orderBy("doc_id").collect()]


def test_labelled_lines(spark, tmp_path):
    path = tmp_path / "train.dat"
    path.write_bytes(b"1 oil up\r\n\n2\tgame  on \n4  bank\xff note\n")
    assert rows(lines.read_labelled(spark, str(path))) == [
        (0, 1, "oil up"), (1, 2, "game  on "), (2, 4, "bank� note"),
    ]
    assert rows(lines.read_labelled(spark, str(path), max_rows=1)) == [(0, 1, "oil up")]


@pytest.mark.parametrize("bad", ["5 text", "1", "text", "12 text"])
def test_bad_lines_raise_or_go_to_quarantine(spark, tmp_path, bad):
    path = tmp_path / "train.dat"
    path.write_text(f"1 fine\n{bad}\n")
    with pytest.raises(Exception, match="Bad labelled line"):
        lines.read_labelled(spark, str(path)).collect()
    quarantined = lines.bad_lines(lines.with_line_ids(spark.read.text(str(path)))).collect()
    assert [(r["doc_id"], r["value"]) for r in quarantined] == [(1, bad)]


def test_lenient_lines(spark, tmp_path):
    path = tmp_path / "train.dat"
    path.write_text("  7 seven words \n\n12\n3 x\n")
    assert rows(lines.read_labelled(spark, str(path), strict=False)) == [
        (0, 7, "seven words"), (1, 12, ""), (2, 3, "x"),
    ]


def test_unlabelled_lines_keep_or_drop_blanks(spark, tmp_path):
    path = tmp_path / "test.dat"
    path.write_text("one\n\n  two \n")
    assert rows(lines.read_unlabelled(spark, str(path))) == [(0, "one"), (1, ""), (2, "  two ")]
    assert rows(lines.read_unlabelled(spark, str(path), keep_blank=False)) == [(0, "one"), (1, "two")]


def test_line_ids_over_many_splits(spark, tmp_path):
    path = tmp_path / "long.dat"
    path.write_text("".join(f"line {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = rows(lines.read_unlabelled(spark, str(path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, f"line {i}") for i in range(5000)]


def test_prediction_sink_and_reconciliation(spark, tmp_path):
    made = spark.createDataFrame([(i, i % 4 + 1) for i in range(50)], "doc_id bigint, pred int").repartition(6)
    predictions.write_lines(made, str(tmp_path / "out"))
    assert rows(lines.read_unlabelled(spark, str(tmp_path / "out"))) == [(i, str(i % 4 + 1)) for i in range(50)]
    predictions.write_keyed(made, str(tmp_path / "keyed"))
    assert spark.read.parquet(str(tmp_path / "keyed")).count() == 50
    template = spark.range(2, 60).withColumnRenamed("id", "doc_id")
    assert tuple(predictions.reconcile(made, template).first()) == (50, 58, 2, 10)


def test_files_to_predictions(spark, tmp_path):
    topics = {1: "oil price market barrel", 2: "game team match goal", 3: "phone chip screen device", 4: "bank loan rate credit"}
    train = "".join(f"{c} {words} item {i}\n" for i in range(12) for c, words in topics.items())
    (tmp_path / "train.dat").write_text(train)
    (tmp_path / "test.dat").write_text("oil barrel\nteam goal\n\nloan credit rate\n")
    f1 = cl.classify_files(
        spark, str(tmp_path / "train.dat"), str(tmp_path / "test.dat"), str(tmp_path / "out"),
        {"bm25": ps.Representation(max_order=1)}, k=5, prf_n=2,
    )
    assert f1.first()[0] == 1.0
    got = rows(lines.read_unlabelled(spark, str(tmp_path / "out")))
    assert got == [(0, "1"), (1, "2"), (2, "1"), (3, "4")]


def test_lsi_guards(spark):
    docs = spark.createDataFrame([(1, 1, "a")], "doc_id bigint, label int, text string")
    with pytest.raises(ValueError, match="LSI needs"):
        cl.classify(docs, docs, {"sublinear": ps.SUBLINEAR}, lsi=ps.LsiSpec())
    with pytest.raises(ValueError, match="cosine"):
        cl.classify(docs, docs, {"bm25": ps.BM25}, lsi=ps.LsiSpec(), metric="euclidean")
    with pytest.raises(ValueError, match="lemma"):
        ps.bag_of(ps.MODELS["m5"], docs)
