"""Alignment, posting lists and collocations against brute force and edge rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import re

from nearlex.llm import alignment, collocations, postings
from tests.llm.test_operators import EDGE, corpus

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a ", " a", "a  b", "a\n b\n\nc \t d", "▁x y", "a b   c\n", "<|endoftext|> <s> x", "\x00\x1c q",
    "x<|endoftext|>y", "<0x41> A", "日本語 é ﬁ", "a b c  d", "it's we'll 12 345,6",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def own():
    return alignment.Tokenizers(open(A, "rb").read(), open(B, "rb").read(), public_tokenizers.PATTERN)


def plain_alignment(text, libraries, own):
    """(A ids, B ids, groups, links) from the libraries, ends compared one by one."""
    if not text:
        return [], [], "", []
    a = libraries[0].encode(" " + text, add_special_tokens=False).ids
    b, whole = libraries[1].encode(text), (" " + text).encode()
    if not b"".join(own.a_bytes[i] for i in a) == whole == b"".join(own.b_bytes[i] for i in b):
        return [], [], "", []
    ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((own.a_bytes, a), (own.b_bytes, b))]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    spans = [list(zip([0, *e], e)) for e in ends]
    links = [(a[x], b[y]) for x, (s, t) in enumerate(spans[0]) for y, (u, v) in enumerate(spans[1]) if s < v and u < t]
    return a, b, ";".join(groups), links


def plain_table(texts, libraries, own):
    made = [plain_alignment(t or "", libraries, own) for t in texts]
    held = Counter(pair for m in made for pair in set(m[3]))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return [
        (
            len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(held[p] == top[p[0]] for p in links),
            sum(held[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "",
        )
        for a, b, g, links in made
    ]


def test_pieces_of_any_size_give_one_merge():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(rng.integers(1, 60, rng.integers(1, 30)))
        b = np.unique(np.append(rng.integers(1, 60, rng.integers(1, 30)), a[-1]))
        a = np.unique(np.append(a, b[-1]))
        want = [(int((a < e).sum()), int((b < e).sum()), e in a and e in b) for e in np.union1d(a, b)]
        for size in (1, 2, 3, 7, 100):
            assert [tuple(x) for x in zip(*(c.tolist() for c in alignment.merged(a, b, size)))] == want


def test_every_token_of_the_vocabulary_is_encoded_as_by_the_library(libraries, own):
    words = [x.decode() for x in own.a_bytes if x.isascii()]
    for k in range(0, len(words), 5000):
        got = libraries[0].encode_batch(words[k : k + 5000], add_special_tokens=False)
        assert [own.a.encode_ordinary(w) for w in words[k : k + 5000]] == [e.ids for e in got]


@pytest.mark.parametrize("table_pairs", [1 << 18, 40, 0])
def test_alignment_is_the_brute_force(spark, libraries, own, table_pairs):
    rng = random.Random(5)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()
    texts = [r.text[:1500] for r in given] + ODD + [None, None]
    texts += ["".join(rng.choice(" \n\tab.'s1é日▁  \x1c<|>") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    docs = corpus(spark, list(enumerate(texts)))
    got = alignment.align(docs, A, B, public_tokenizers.PATTERN, table_pairs).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == plain_table(texts, libraries, own)


def test_alignment_edge_rows(spark, libraries, own):
    rows = [r for r in EDGE if r[0] != 6]
    got = alignment.align(corpus(spark, EDGE), A, B, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.count() == len(EDGE) > len(rows)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[1][1:] == (0, 0, 0, 0, 0, 0, "") == by_id[2][1:]
    assert by_id[4][1:] == by_id[5][1:] and by_id[None].n_a > 0 and by_id[6].n_groups > 50_000
    assert alignment.align(corpus(spark, []), A, B, public_tokenizers.PATTERN).count() == 0


# -- posting lists ---------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, list int, score string, vec int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], VECTORS)


def true_neighbours(rows, q, k):
    """(vec_id, distance) of the nearest rows of ``rows[q]``, ties to the smaller id, null last."""
    x = np.array(rows[q][1], np.float32).astype(float)
    far = [
        (float(np.sqrt(((np.array(v, np.float32).astype(float) - x) ** 2).sum())), i is None, i or 0)
        for n, (i, v) in enumerate(rows) if n != q
    ]
    return [(None if none else i, d) for d, none, i in sorted(far)[:k]]


@pytest.mark.parametrize("clusters", [0, 30])
def test_posting_lists_find_the_neighbours(spark, clusters, monkeypatch):
    monkeypatch.setattr(postings, "LIST_ROWS", 50)
    monkeypatch.setattr(postings, "PART_ROWS", 64)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 16))
    if clusters:
        x = 0.15 * x + rng.normal(size=(clusters, 16))[rng.integers(0, clusters, len(x))]
    x[2000:3300] = x[1999]  # a third of all rows share a vector
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    table = vectors(spark, rows)
    got = defaultdict(list)
    for r in postings.search(table, table.filter("vec_id % 50 = 0"), 10).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 4000, 50))
    hits = 0
    for q, found in got.items():
        found.sort()
        want = true_neighbours(rows, q, 10)
        assert [r for r, *_ in found] == list(range(1, 11))
        assert [f[1:] for f in found] == sorted((f[1:] for f in found), key=lambda f: (f[1], f[0]))
        for _, i, d in found:
            assert d == pytest.approx(np.sqrt(((np.float32(rows[i][1]).astype(float) - np.float32(rows[q][1])) ** 2).sum()))
        if 2000 <= q < 3300:
            assert [f[1] for f in found] == [i for i, _ in want]
        hits += len({i for i, _ in want} & {f[1] for f in found})
    assert hits / (10 * len(got)) >= 0.9


def test_clusters_are_pruned():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    near = (0.05 * rng.normal(size=(8000, 16)) + centres[rng.integers(0, 40, 8000)]).astype(float)
    index = postings.fit(near, len(near) * 4, 10)
    row, at, _ = index.within(near[:200], index.ratio)
    assert len(at) / 200 < 0.25 * len(index.centroids)
    # The graph finds what a full comparison finds.
    far = postings.distances(near[:200], index.centroids)
    want = far <= far.min(1)[:, None] * index.ratio
    assert len(at) >= 0.99 * want.sum()


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.0, 2.0]), (None, [1.0, 0.0]), (2, [0.0, 0.0]),
        (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, None), (7, []), (200, [1.0, 2.0, 3.0]),
    ]
    table = vectors(spark, rows)
    got = sorted(tuple(r) for r in postings.search(table, table.filter("vec_id % 100 = 0"), 10).collect())
    whole = [r for r in rows if r[1] and len(r[1]) == 2 and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    want = [
        (i, rank, *found)
        for q, (i, _) in enumerate(whole) if i is not None and i % 100 == 0
        for rank, found in enumerate(true_neighbours(whole, q, 10), 1)
    ]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert postings.search(table.filter("false"), table.filter("false"), 10).count() == 0


# -- collocations ----------------------------------------------------------------


def plain_collocations(rows, least, longest, best):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        found = []
        for p, a in frequent.items():
            if inside[p] < a:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def phrases():
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "delta", "é", "日本", "x.y", "e", "f\tg", "h", "zz zz"]
    rows = [
        (i, " ".join(rng.choices(words, [9, 8, 7, 6, 5, 4, 2, 2, 1, 1, 1], k=rng.randint(0, 60))) + rng.choice(["", ".", "\n", " new york city hall now"]),
         rng.choice(["en", "de", None, "und"]))
        for i in range(600)
    ]
    return [*rows, *EDGE, (9, None, "en")]


@pytest.mark.parametrize("entries", [1 << 20, 6, 0])
def test_collocations_are_the_brute_force(spark, phrases, entries):
    got = collocations.mine(corpus(spark, phrases), 30, 5, 40, entries)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(phrases, 30, 5, 40)


def test_tiles_count_like_coordinates(monkeypatch):
    rng = np.random.default_rng(6)
    left, right = (np.minimum(rng.zipf(1.3, 50_000), 9_000).astype(np.int64) for _ in range(2))
    left[:50] |= 1 << 62
    want = Counter(zip(left.tolist(), right.tolist()))
    for side, share in ((1024, 1 / 16), (32, 1 / 64)):
        monkeypatch.setattr(collocations, "TILE", side)
        monkeypatch.setattr(collocations, "DENSE_SHARE", share)
        a, b, n = collocations.tile_counts(left, right)
        assert Counter(dict(zip(zip(a.tolist(), b.tolist()), n.tolist()))) == want and len(a) == len(want)


def test_rows_of_word_ids_are_short_and_end_with_a_break(spark):
    # One split of many texts: a row once held all of a batch, megabytes that readers and writers hold by the hundred.
    rows = [(i, "one two three. " * 40 + "four, five " * 10, "en") for i in range(400)]
    keys = np.array([collocations.word_key("en", w) for w in (b"one", b"two", b"three", b"four", b"five")])
    lookup = collocations.Lookup(keys, np.arange(5), True)
    made = [r["ids"] for r in collocations.sequences(corpus(spark, rows).coalesce(1), lookup).collect()]
    assert max(map(len, made)) <= 2 * collocations.ROW_IDS
    assert all(ids[-1] == collocations.BREAK for ids in made)
    assert sum(i != collocations.BREAK for ids in made for i in ids) == 400 * 140


def test_rows_are_cut_at_breaks_only():
    ids = np.array([1, -1, 2, 3, 4, 5, 6, 7, -1, 8, -1, 9, 9, -1])
    assert collocations.cut_at_breaks(ids, 4).tolist() == [2, 11, 14]
    assert collocations.cut_at_breaks(ids[:0], 4).tolist() == []


def test_few_held_words_count_the_same(spark, phrases, monkeypatch):
    want = sorted(map(tuple, collocations.word_counts(corpus(spark, phrases)).collect()), key=repr)
    monkeypatch.setattr(collocations, "HELD_WORDS", 5)
    monkeypatch.setattr(collocations, "ABREAST_BYTES", 50)
    assert sorted(map(tuple, collocations.word_counts(corpus(spark, phrases)).collect()), key=repr) == want


def test_no_documents_no_phrases(spark):
    assert collocations.mine(corpus(spark, [])).count() == 0
    assert collocations.mine(corpus(spark, [(1, None), (2, "")])).count() == 0
