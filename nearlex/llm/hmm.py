"""Hidden Markov language model with latent states, trained by Baum-Welch.

Token counts are a Spark aggregate over all training texts.  The most frequent
words are symbols of their own; the others share symbols by their ending, and a
word's probability within its symbol comes from its count, so unseen words have
a probability too and the model is a proper distribution over texts.

Every training pass is one job: partitions add up expected start, transition and
emission counts of their texts (forward-backward, scaled at each token), Spark
sums them, and the driver, which holds only states times symbols numbers, makes
the next parameters.  Scoring is the scaled forward recursion over the whole
text.  Texts longer than ``SPAN`` tokens are cut into spans; for scoring the
spans are run from every state and chained, which is exact, and for training a
span is a sequence of its own.

Counts of words outside the broadcast table are joined to the tokens that need
them, so no vocabulary has to fit anywhere.

Edge cases: a null or empty text is the end token alone.  A null id is not held
out.  Without training texts the model is uniform.  Repeated rows count each.
Extra columns are dropped.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from nearlex.llm.base import bound_batches, remainder, texts
from nearlex.session import stage

#: The end of a text; no word contains a line break.
END = "\n"
#: Words whose counts are broadcast, and those of them that are symbols.
TABLE_WORDS = 200_000
SYMBOL_WORDS = 16_000
ENDINGS = 64
STATES = 6
PASSES = 2
#: Texts of the sample from which the states start.
SEED_TEXTS = 384
SPAN = 2048
#: Texts worked on side by side.
ABREAST = 512
#: Weight, in tokens, of the corpus frequencies in the emissions of a state.
PRIOR_TOKENS = 200.0


def split_words(text: str) -> list[bytes]:
    """Words of a text with A to Z lower-cased, as bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def ending(word: str) -> int:
    """The shared symbol of a word by its last two characters, as Spark's xxhash64 would."""
    return xxhash.xxh64_intdigest(word[-2:].encode("utf-8", "surrogatepass"), 42) % ENDINGS


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, c) over all texts, with one end token for each."""

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in texts(batch):
                held.update(split_words(text))
            held[END.encode()] += batch.num_rows
            if len(held) > 300_000:
                yield _counted(held)
                held.clear()
        yield _counted(held)

    return docs.select("text").mapInArrow(count, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("c"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held.keys()), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
        names=["token", "n"],
    )


@dataclass
class Lexicon:
    """Broadcast part of the counts: the frequent words and the shared symbols."""

    place: dict[bytes, int]  # frequent word to row of the arrays
    log_count: np.ndarray  # log10(c + 1)
    symbol: np.ndarray
    within: np.ndarray  # log10 probability within the symbol, without its norm: 0 for words of their own
    norm: np.ndarray  # log10 of the mass of each shared symbol
    mass: np.ndarray  # of each symbol
    tokens: int
    distinct: int

    @property
    def words(self) -> int:
        return len(self.mass) - ENDINGS


def lexicon(counts: DataFrame, table_words: int = TABLE_WORDS, symbol_words: int = SYMBOL_WORDS) -> Lexicon:
    """Take the words above the count at which the table is full."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # One row for each count that occurs.
    ladder = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "above", F.sum("n").over(Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0))
    )
    least = ladder.filter(F.col("above") <= table_words).agg(F.min("c")).first()[0]
    top = [] if least is None else counts.filter(F.col("c") >= least).collect()  # at most table_words rows
    top = sorted(((r["c"], r["token"]) for r in top), key=lambda x: (-x[0], x[1]))
    own = {w for _, w in top[:symbol_words]}
    masses = counts.groupBy(F.pmod(F.xxhash64(F.substring("token", -2, 2)), F.lit(ENDINGS)).alias("b")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")
    ).collect()
    shared = np.ones(ENDINGS)
    for row in masses:
        shared[row["b"]] += row["c"] + row["v"]
    for c, w in top[:symbol_words]:
        shared[ending(w)] -= c + 1
    m = len(own)
    symbol = np.array([i if i < m else m + ending(w) for i, (_, w) in enumerate(top)], dtype=np.int32)
    log_count = np.log10(np.array([c + 1.0 for c, _ in top]))
    within = np.where(np.arange(len(top)) < m, 0.0, log_count)
    mass = np.concatenate([[c + 1.0 for c, _ in top[:symbol_words]], shared])
    place = {w.encode("utf-8", "surrogatepass"): i for i, (_, w) in enumerate(top)}
    return Lexicon(place, log_count, symbol, within, np.log10(shared), mass, int(total[0]), int(total[1]))


def encode(docs: DataFrame, words: Lexicon) -> DataFrame:
    """uid, doc_id, held_out, symbols, sums over frequent words, and the other words to look up."""
    sent = docs.sparkSession.sparkContext.broadcast(words)
    kind = dict(docs.dtypes)["doc_id"]
    shape = (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_table bigint, table_log double,"
        " within_log double, symbols binary, others array<string>"
    )

    def run(batches):
        w = sent.value
        get, m, end = w.place.get, w.words, END.encode()
        log_count, within = np.append(w.log_count, 0.0), np.append(w.within, 0.0)
        symbol_of = np.append(w.symbol, 0)
        endings: dict[str, int] = {}
        for batch in batches:
            rows = []
            for text in texts(batch):
                tokens = split_words(text)
                tokens.append(end)
                at = np.fromiter((get(t, -1) for t in tokens), np.int64, len(tokens))
                symbols = symbol_of[at]
                missing = np.flatnonzero(at < 0)
                others = []
                for i in missing.tolist():
                    word = tokens[i].decode("utf-8", "replace")
                    others.append(word)
                    tail = word[-2:]
                    if tail not in endings:
                        endings[tail] = ending(tail)
                    symbols[i] = m + endings[tail]
                shared = symbols[symbols >= m] - m
                rows.append((
                    len(tokens), len(tokens) - len(others), float(log_count[at].sum()),
                    float(within[at].sum() - w.norm[shared].sum()), symbols.astype("<u2").tobytes(), others,
                ))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out")]
                + [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                names=["doc_id", "held_out", "n_tokens", "n_table", "table_log", "within_log", "symbols", "others"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, shape)


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states


def _groups(sequences: list[np.ndarray]):
    """Texts of similar length side by side, longest first: (indices, lengths, padded symbols)."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    for at in range(0, len(order), ABREAST):
        mine = order[at : at + ABREAST]
        lengths = np.array([len(sequences[i]) for i in mine])
        padded = np.zeros((lengths[0], len(mine)), np.int64)
        for column, i in enumerate(mine):
            padded[: lengths[column], column] = sequences[i]
        yield mine, lengths, padded


def log_likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of whole sequences by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    short = [i for i, s in enumerate(sequences) if len(s) <= SPAN]
    for mine, lengths, padded in _groups([sequences[i] for i in short]):
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        total = np.zeros(len(mine))
        alpha = model.start * model.emit[padded[0]]
        for t in range(lengths[0]):
            n = active[t]
            if t:
                alpha = (alpha[:n] @ model.move) * model.emit[padded[t, :n]]
            scale = alpha.sum(axis=1)
            total[:n] += np.log(scale)
            alpha = alpha / scale[:, None]
        out[[short[i] for i in mine]] = total
    for i, sequence in enumerate(sequences):
        if len(sequence) > SPAN:
            out[i] = _long_log_likelihood(model, sequence)
    return out


def _long_log_likelihood(model: Model, sequence: np.ndarray) -> float:
    """The same for a long sequence: its spans side by side from every state, then chained."""
    k = len(model.start)
    alpha = model.start * model.emit[sequence[0]]
    total = math.log(alpha.sum())
    alpha = alpha / alpha.sum()
    rest = sequence[1:]
    for block in range(0, len(rest), SPAN * 64):
        piece = rest[block : block + SPAN * 64]
        spans = [piece[a : a + 512] for a in range(0, len(piece), 512)]
        lengths = np.array([len(s) for s in spans])  # all but the last are equal
        through = np.broadcast_to(np.eye(k), (len(spans), k, k)).copy()
        scales = np.zeros((len(spans), k))
        for t in range(lengths[0]):
            n = int((lengths > t).sum())
            symbols = np.array([s[t] for s in spans[:n]])
            step = (through[:n] @ model.move) * model.emit[symbols][:, None, :]
            scale = step.sum(axis=2)
            through[:n] = step / scale[:, :, None]
            scales[:n] += np.log(scale)
        for span in range(len(spans)):
            top = scales[span].max()
            alpha = (alpha * np.exp(scales[span] - top)) @ through[span]
            total += top + math.log(alpha.sum())
            alpha = alpha / alpha.sum()
    return total


def expected_counts(model: Model, sequences: list[np.ndarray], into: np.ndarray) -> None:
    """Add expected counts: row 0 starts, rows 1 to states moves, the rest emissions."""
    k = len(model.start)
    spans = [s[a : a + SPAN] for s in sequences for a in range(0, len(s), SPAN)]
    for _, lengths, padded in _groups(spans):
        steps = int(lengths[0])
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        seen = model.emit[padded]  # steps x texts x states
        alpha = np.zeros(seen.shape)
        scale = np.ones(padded.shape)
        now = model.start * seen[0]
        for t in range(steps):
            n = active[t]
            if t:
                now = (alpha[t - 1, :n] @ model.move) * seen[t, :n]
            scale[t, :n] = now.sum(axis=1)
            alpha[t, :n] = now / scale[t, :n, None]
        beta = np.ones((padded.shape[1], k))
        moved = np.zeros((k, k))
        for t in range(steps - 1, -1, -1):
            n = active[t]
            if t < steps - 1:
                after = active[t + 1]
                ahead = seen[t + 1, :after] * beta[:after] / scale[t + 1, :after, None]
                moved += alpha[t, :after].T @ ahead
                beta[:after] = ahead @ model.move.T
            alpha[t, :n] *= beta[:n]  # the posterior of the states
        into[0] += alpha[0].sum(axis=0)
        into[1 : k + 1] += moved * model.move
        real = np.arange(steps)[:, None] < lengths[None, :]
        symbols, posterior = padded[real], alpha[real]
        for j in range(k):
            into[k + 1 :, j] += np.bincount(symbols, posterior[:, j], minlength=len(into) - k - 1)


def maximised(counts: np.ndarray, mass: np.ndarray) -> Model:
    """Parameters from expected counts, with the corpus frequencies as a prior of the emissions."""
    k = counts.shape[1]
    start = counts[0] + 1.0
    move = counts[1 : k + 1] + 0.1
    emit = counts[k + 1 :] + PRIOR_TOKENS * (mass / mass.sum())[:, None]
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def seeded(sample: list[np.ndarray], mass: np.ndarray, states: int, rounds: int = 8) -> Model:
    """A first model: the sample's texts are clustered by their symbols, one state a cluster."""
    size = len(mass)
    counts = np.zeros((1 + states + size, states))
    counts[1 : states + 1] = 1.0 + 99.0 * states * np.eye(states)
    if sample:
        bags = np.stack([np.bincount(s, minlength=size) for s in sample]).astype(np.float64)
        unit = np.sqrt(bags / bags.sum(axis=1, keepdims=True))
        chosen = [0]
        while len(chosen) < min(states, len(sample)):
            chosen.append(int((unit @ unit[chosen].T).max(axis=1).argmin()))
        group = (unit @ unit[chosen].T).argmax(axis=1)
        for _ in range(rounds):
            emit = np.stack([bags[group == j].sum(axis=0) for j in range(states)], axis=1)
            emit += PRIOR_TOKENS * (mass / mass.sum())[:, None]
            group = (bags @ np.log(emit / emit.sum(axis=0))).argmax(axis=1)
        for j in range(states):
            counts[1 + states :, j] = bags[group == j].sum(axis=0)
            counts[0, j] = (group == j).sum()
    return maximised(counts, mass)


def train(encoded: DataFrame, words: Lexicon, states: int = STATES, passes: int = PASSES) -> Model:
    """Baum-Welch over all rows that are not held out."""
    learned = encoded.filter(~F.col("held_out"))
    picked = (
        learned.filter(F.col("n_tokens").between(30, 3000))
        .select(F.xxhash64(F.col("symbols")).alias("h"), "symbols")
        .orderBy("h").limit(SEED_TEXTS).collect()
    )
    sample = [np.frombuffer(r["symbols"], "<u2").astype(np.int64) for r in picked]
    model = seeded(sample, words.mass, states)
    size = 1 + states + len(words.mass)
    names = [f"s{j}" for j in range(states)]
    context = encoded.sparkSession.sparkContext
    for _ in range(passes):
        sent = context.broadcast(model)  # states x symbols numbers

        def expect(batches):
            held = np.zeros((size, states))
            for batch in batches:
                sequences = [np.frombuffer(s, "<u2").astype(np.int64) for s in batch.column("symbols").to_pylist()]
                expected_counts(sent.value, sequences, held)
            rows = np.flatnonzero(held.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32())] + [pa.array(held[rows, j]) for j in range(states)], names=["at", *names]
            )

        summed = (
            learned.select("symbols")
            .mapInArrow(expect, "at int, " + ", ".join(f"{n} double" for n in names))
            .groupBy("at").agg(*[F.sum(n).alias(n) for n in names])
            .collect()
        )
        counts = np.zeros((size, states))
        for row in summed:
            counts[row["at"]] = row[1:]
        model = maximised(counts, words.mass)
    return model


def score(docs: DataFrame, states: int = STATES, passes: int = PASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    bound_batches(docs.sparkSession)
    marked = docs.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "text")
    counts = stage(count_tokens(marked.filter(~F.col("held_out"))), "tokens")
    words = lexicon(counts)
    encoded = stage(encode(marked, words).withColumn("uid", F.monotonically_increasing_id()), "encoded")
    model = docs.sparkSession.sparkContext.broadcast(train(encoded, words, states, passes))

    def run(batches):
        for batch in batches:
            sequences = [np.frombuffer(s, "<u2").astype(np.int64) for s in batch.column("symbols").to_pylist()]
            made = log_likelihood(model.value, sequences) / math.log(10.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array(made)], names=["uid", "path_log"]
            )

    scored = encoded.select("uid", "symbols").mapInArrow(run, "uid bigint, path_log double")
    looked = (
        encoded.select("uid", F.explode("others").alias("token"))
        .join(counts, "token", "left")
        .groupBy("uid")
        .agg(
            F.count("c").alias("n_other"),
            F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("other_log"),
        )
    )
    other, unit = F.coalesce("other_log", F.lit(0.0)), math.log10(words.tokens + words.distinct + 1)
    return (
        encoded.drop("symbols", "others").join(scored, "uid").join(looked, "uid", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_table") + F.coalesce("n_other", F.lit(0))).alias("n_known"),
            F.lit(words.tokens).cast("long").alias("train_tokens"),
            (F.col("table_log") + other - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
            (F.col("path_log") + F.col("within_log") + other).alias("score"),
        )
    )
