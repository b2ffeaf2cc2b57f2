import pytest
from pyspark.sql import functions as F

from nearlex.functions import porter, text as tx
from nearlex.functions.stopwords import ENGLISH
from nearlex.operators import bags as bg


def value(spark, text, expression):
    frame = spark.createDataFrame([(text,)], "text string")
    return frame.select(expression(F.col("text")).alias("v")).first()["v"]


def test_simple_and_rich_treat_apostrophes_apart(spark):
    assert value(spark, "I don't", tx.letter_runs) == ["i", "don", "t"]
    assert value(spark, "I don't", lambda t: tx.split_words(tx.strip_punctuation(t))) == ["i", "dont"]


@pytest.mark.parametrize("text", ["", " \t\n", "  ", "!!!"])
def test_empty_texts_have_no_tokens(spark, text):
    assert value(spark, text, bg.rich_analyzer(3)) == []


def test_unicode_whitespace_splits(spark):
    assert value(spark, "a b c\x1cd\re", tx.split_words) == list("abcde")


def test_stop_words_and_short_tokens_go_before_stemming(spark):
    got = value(spark, "The oil prices rise in a x market", bg.rich_analyzer(1))
    assert got == ["oil", "price", "rise", "market"]
    assert len(ENGLISH) == 179 and len(set(ENGLISH)) == 179


@pytest.mark.parametrize("n, bi, tri", [(0, 0, 0), (1, 0, 0), (2, 1, 0), (3, 2, 1), (5, 4, 3)])
def test_ngram_counts(spark, n, bi, tri):
    text = " ".join(f"w{i}" for i in range(n))
    words = lambda t: tx.split_words(t)
    assert len(value(spark, text, lambda t: tx.word_bigrams(words(t)))) == bi
    assert len(value(spark, text, lambda t: tx.word_trigrams(words(t)))) == tri
    every = value(spark, text, lambda t: tx.with_ngrams(words(t), 3))
    assert len(every) == n + bi + tri


def test_ngrams_are_ordered_and_filtered(spark):
    stream = lambda t: tx.with_ngrams(tx.split_words(t), 3)
    assert value(spark, "a b c", stream) == ["a", "b", "c", "a_b", "b_c", "a_b_c"]
    assert value(spark, "a b c", lambda t: tx.keep_orders(stream(t), 2)) == ["a", "b", "c", "a_b", "b_c"]
    assert value(spark, "a b c", lambda t: tx.keep_orders(stream(t), 1)) == ["a", "b", "c"]


def test_char_grams(spark):
    assert value(spark, "oil", tx.char_grams) == ["_oi", "oil", "il_", "_oil", "oil_", "_oil_"]
    assert value(spark, "a ab", tx.char_grams) == ["_ab", "ab_", "_ab_"]


def test_char_grams_in_word_keep_punctuation_and_short_words(spark):
    assert value(spark, "A", lambda t: tx.char_grams_in_word(t, 3, 5)) == [" a "]
    assert value(spark, "A", lambda t: tx.char_grams_in_word(t, 4, 5)) == [" a "]
    assert value(spark, "i,", lambda t: tx.char_grams_in_word(t, 3, 5)) == [" i,", "i, ", " i, "]


def test_counted_matches_a_plain_count(spark):
    got = value(spark, "b a b c a b", lambda t: tx.counted(tx.split_words(t)))
    assert [(r["term"], r["tf"]) for r in got] == [("a", 2), ("b", 3), ("c", 1)]
    assert value(spark, "", lambda t: tx.counted(tx.split_words(t))) == []


# Words and stems published with the algorithm, and the extensions.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "digitizer": "digit", "radicalli": "radic",
    "vietnamization": "vietnam", "operator": "oper", "feudalism": "feudal", "hopefulness": "hope",
    "formaliti": "formal", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "replacement": "replac",
    "adoption": "adopt", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "dying": "die", "died": "die", "skies": "sky", "news": "news", "by": "by",
    "enjoy": "enjoy", "biology": "biolog", "generations": "gener", "tied": "tie", "spied": "spi",
}


@pytest.mark.parametrize("word", sorted(STEMS))
def test_stems(word):
    assert porter.stem_word(word) == STEMS[word]


def test_stem_column_keeps_shape(spark):
    frame = spark.createDataFrame([(1, ["cats", "cats", "sky"]), (2, []), (3, ["ponies"])], "i int, t array<string>")
    got = {r["i"]: r["t"] for r in frame.select("i", porter.stem(F.col("t")).alias("t")).collect()}
    assert got == {1: ["cat", "cat", "sky"], 2: [], 3: ["poni"]}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_table_normaliser_with_and_without_broadcast(spark, limit):
    tokens = spark.createDataFrame([(1, 5, ["geese", "fly", "geese"]), (2, 6, [])], "doc_id bigint, label int, tokens array<string>")
    table = spark.createDataFrame([("geese", "goose")], "token string, lemma string")
    got = bg.normalised_by_table(tokens, table, limit=limit).collect()
    assert {r["doc_id"]: (r["label"], r["tokens"]) for r in got} == {
        1: (5, ["goose", "fly", "goose"]), 2: (6, []),
    }


def test_ngrams_and_counts_are_one_pass(spark):
    """N-grams are made, and counted, where the stems are; they are not sent back in between."""
    docs = spark.createDataFrame([(1, "The oils rising, rising oils!"), (2, ""), (3, None)], "doc_id bigint, text string")
    for analyzer in (bg.rich_analyzer(3), lambda text: tx.char_grams_in_word(text)):
        tokens = docs.select("doc_id", analyzer(F.col("text")).alias("tokens"))
        counts = tokens.select("doc_id", tx.counted_with_length(F.col("tokens")).alias("c")).select("doc_id", "c.dl", "c.terms")
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        want = tokens.select("doc_id", F.size("tokens").alias("dl"), tx.counted(F.col("tokens")).alias("terms"))
        assert sorted(counts.collect()) == sorted(want.collect())


def test_batches_equal_plain_loops():
    import random

    import pyarrow as pa

    from nearlex.functions.batches import bag_batch, count_batch, gram_batch, grams_of, ngram_batch

    rng = random.Random(3)
    words = ["a", "bé", "日本語", "x_y", "_", "𝒳z", "word", "a_b", "b"]
    lists = [None, [], ["x"], *[rng.choices(words, k=rng.randint(0, 9)) for _ in range(60)]]
    given, kind = pa.array(lists, pa.list_(pa.string())), pa.list_(pa.string())
    joined = lambda ws, n: ["_".join(ws[i : i + n]) for i in range(len(ws) - n + 1)]
    for order in (2, 3):
        want = [None if ws is None else ws + sum((joined(ws, n) for n in range(2, order + 1)), []) for ws in lists]
        made = ngram_batch(given, order)
        assert made.cast(kind).to_pylist() == want
        counts = [[{"term": t, "tf": ws.count(t)} for t in sorted(set(ws), key=str.encode)] for ws in ([] if w is None else w for w in want)]
        assert count_batch(made).to_pylist() == counts
        assert bag_batch(made).field("dl").to_pylist() == [None if w is None else len(w) for w in want]
    for cut in ((3, 5, "_", False), (3, 5, " ", True), (1, 2, "_", True)):
        want = [sum((grams_of(w, *cut) for w in ws or []), []) for ws in lists]
        assert gram_batch(given, *cut).cast(kind).to_pylist() == want
