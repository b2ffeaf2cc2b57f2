"""Registration and the stages of the pipeline."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, difference
from nearlex.llm import queries, simhash

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, connect(FOLDER).execute(queries.ORACLES[name]).df()) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, FOLDER).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            assert after.select("doc_id").distinct().join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
        if k < 3:
            assert after.count() <= before.count()
        if k == 2:
            named = simhash.near_duplicates(before)
            assert after.count() == named.select("component_id").distinct().count()
        before = after
    assert corpus_pipeline.run(spark, FOLDER).count() == before.count()


def test_the_last_stage_decodes(spark):
    import hashlib

    docs = spark.createDataFrame(
        [(1, "abc  déf", "en", "a", 8), (None, None, None, None, None), (1, "", "en", "b", 0)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    got = corpus_pipeline.byte_level_bpe(spark, docs, FOLDER).collect()
    want = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect())
    assert sorted(r.decoded_sha256 for r in got) == want


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
