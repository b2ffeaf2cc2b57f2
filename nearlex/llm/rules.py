"""Quality rules: base counts and compression bands.

Zstandard ratios (compressed over raw bytes) of the whole text and of fixed
chunks are compared with limits that depend on the length: text that shrinks too
far is repetitive, text that hardly shrinks is not prose.  A text is rejected by
its whole ratio, or if adjacent chunks outside their band are ``RUN_BYTES`` long
together, however long the text around them is.  Short chunks find encoded parts,
long ones repetition over a wide distance.

Edge cases: a null text counts as empty; both have no word and fail the base
rule.  A text too short for a limit passes it.  Repeated rows and null ids are
judged like any other row.  Extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearlex.llm.base import arrow_step, bound_batches, replaced, texts

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEVEL = 3
#: Bytes of a chunk; a text is cut once by each.  A last piece below half of it joins the chunk before.
CHUNK_BYTES = (1024, 4096)
#: Adjacent bad chunks of this many bytes reject a text: any 3,071 bytes of junk in a row fill two short chunks.
RUN_BYTES = 2048
#: (bytes from, lowest ratio, highest ratio); the frame of a short text alone outweighs its gain.
BANDS = (
    (0, 0.00, 99.0), (64, 0.50, 1.40), (128, 0.42, 1.10), (256, 0.38, 0.95), (512, 0.36, 0.84),
    (1024, 0.33, 0.72), (4096, 0.30, 0.70), (16384, 0.25, 0.68),
)
_FROM = np.array([b[0] for b in BANDS])


def outside(ratio: float, size: int) -> bool:
    """Whether a ratio is outside the band of its length."""
    _, low, high = BANDS[int(np.searchsorted(_FROM, size, side="right")) - 1]
    return not low <= ratio <= high


def chunks_of(raw: memoryview, size: int) -> list[memoryview]:
    """Chunks of ``size`` bytes, the last one half to one and a half times as long; none for a shorter text."""
    cuts = list(range(0, len(raw), size))
    if len(cuts) > 1 and len(raw) - cuts[-1] < size // 2:
        cuts.pop()
    return [raw[at:to] for at, to in zip(cuts, [*cuts[1:], len(raw)])] if len(raw) >= size else []


def bad_runs(raw: memoryview, press: zstandard.ZstdCompressor) -> tuple[int, int, int]:
    """Chunks outside their band, all chunks, and bytes of the longest run of adjacent bad ones."""
    bad = total = longest = 0
    for size in CHUNK_BYTES:
        run = 0
        for chunk in chunks_of(raw, size):
            total += 1
            if outside(len(press.compress(chunk)) / len(chunk), len(chunk)):
                bad += 1
                run += len(chunk)
                longest = max(longest, run)
            else:
                run = 0
    return bad, total, longest


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window found at least twice, its first place included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    key, size = codes[:n], len(seen)
    for step in range(1, window):
        if step > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * size + codes[step : step + n]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(len(words), bool)
    for step in range(window):
        covered[step : step + n] |= twice
    return int(covered.sum())


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, ratio double, bad_chunks bigint, n_chunks bigint, bad_run bigint, kept boolean"
)


def judge(text: str, press: zstandard.ZstdCompressor) -> tuple:
    """The fields of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeat = repeated_words(words)
    base_failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    whole = len(press.compress(raw)) / len(raw) if raw else 1.0
    bad, n_chunks, run = bad_runs(memoryview(raw), press)
    fits = not outside(whole, len(raw)) and run < RUN_BYTES
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeat, base_failed, whole, bad, n_chunks, run,
        not base_failed and fits,
    )


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, compression ratios and verdict of every row of ``docs``."""
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    names = [field.split()[0] for field in FIELDS.split(", ")]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=LEVEL)
        rows = [judge(t, press) for t in texts(batch)]
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), *[pa.int64()] * 3, pa.bool_()]
        columns = {n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))}
        return replaced(batch, "text", **columns)

    return arrow_step(docs.select("doc_id", "text"), f"doc_id {kind}, {FIELDS}", step)


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("boolean")
    def kept(text):
        press = zstandard.ZstdCompressor(level=LEVEL)
        return text.__class__([judge(t or "", press)[-1] for t in text], index=text.index, dtype=bool)

    return docs.filter(kept(F.col("text")))
