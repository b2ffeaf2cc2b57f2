from __future__ import annotations

import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("nearlex-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stages")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from nearlex.session import ship_package

    ship_package(session)
    yield session
    session.stop()


TRAIN = [
    (0, 1, "oil price rise"),
    (1, 1, "oil market"),
    (2, 2, "game team win"),
    (3, 3, "phone price"),
    (4, 4, "market bank rise rise"),
]
QUERIES = [(100, "oil rise"), (101, "team game"), (102, "zebra")]


@pytest.fixture(scope="session")
def micro(spark):
    """Bags, vocabulary and vectors of the hand-computed corpus."""
    from types import SimpleNamespace

    from pyspark.sql import functions as F

    from nearlex.functions.text import split_words
    from nearlex.operators import bags as bg, vectors as vx
    from nearlex.operators.vocabulary import fit_vocabulary

    docs = spark.createDataFrame(TRAIN, "doc_id bigint, label int, text string")
    asked = spark.createDataFrame(QUERIES, "doc_id bigint, text string")
    bag = bg.bags(bg.tokenised(docs, split_words))
    asked_bag = bg.bags(bg.tokenised(asked, split_words))
    n, avgdl = bg.corpus_stats(bag)
    vocab = fit_vocabulary(bag, n, min_df=1, idf="bm25")
    smooth = fit_vocabulary(bag, n, min_df=1, idf="smooth")
    weight = vx.bm25_weight(avgdl)
    return SimpleNamespace(
        bag=bag, asked_bag=asked_bag, n=n, avgdl=avgdl, vocab=vocab, smooth=smooth,
        train=vx.weigh(bag, vocab, weight), queries=vx.weigh(asked_bag, vocab, weight),
        sublinear=vx.weigh(bag, smooth, vx.sublinear_weight()), F=F,
    )
