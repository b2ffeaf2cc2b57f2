"""Porter stemming (M. F. Porter, 1980), with the usual published extensions.

Stemming is the one text step Spark SQL cannot express.  ``stem`` runs on Arrow
batches: the tokens of a batch are dictionary-encoded first, so every distinct
word is stemmed once per batch and only codes are handled after that.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from nearlex.functions.batches import coded, listed

# Words with a stem of their own.
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "inning": "inning", "innings": "inning", "outing": "outing",
    "outings": "outing", "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix replacements of step 2, used when the measure is positive.
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)

# Suffix replacements of step 3, used when the measure is positive.
_STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)

# Suffixes removed in step 4, used when the measure exceeds one.
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# Most words have none of the suffixes, which one call tells.
_ENDS = {rules: tuple(r[0] for r in rules) for rules in (_STEP2, _STEP3)}


class _Letters(dict):
    def __missing__(self, letter):
        self[letter] = "c"
        return "c"


_LETTERS = _Letters({ord(v): "v" for v in "aeiou"})


def _shape(stem: str) -> str:
    """Write a stem as consonants ``c`` and vowels ``v``."""
    if "y" not in stem:
        return stem.translate(_LETTERS)
    out: list[str] = []
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and bool(out) and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    for suffix, cut in (("sses", 2), ("ies", 2), ("ss", 0), ("s", 1)):
        if w.endswith(suffix):
            return w[: len(w) - cut]
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if not _has_vowel(stem):
                return w
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
    return w


def _replace(w: str, rules) -> str:
    """Apply the longest matching suffix rule when its stem has a measure."""
    if not w.endswith(_ENDS[rules]):
        return w
    found = max((r for r in rules if w.endswith(r[0])), key=lambda r: len(r[0]), default=None)
    if found is None:
        return w
    stem = w[: -len(found[0])]
    return stem + found[1] if _measure(stem) > 0 else w


def _derive(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derive(w[:-2])
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _replace(w, _STEP2)


def _drop_suffix(w: str) -> str:
    if not w.endswith(_STEP4):
        return w
    suffix = max((s for s in _STEP4 if w.endswith(s)), key=len, default=None)
    if suffix is None:
        return w
    stem = w[: -len(suffix)]
    if _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t")):
        return stem
    return w


def _tidy(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


@lru_cache(maxsize=200_000)
def stem_word(word: str) -> str:
    """Stem of one lower-case word."""
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = _past(_plural(word))
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c":
        w = w[:-1] + "i"
    return _tidy(_drop_suffix(_replace(_derive(w), _STEP3)))


def _stem_batch(tokens: pa.Array) -> pa.Array:
    codes, words, sizes = coded(tokens)
    # Words of one stem get one code.
    stems = pa.array([stem_word(w) for w in words.to_pylist()], pa.string()).dictionary_encode()
    return listed(np.asarray(stems.indices)[codes], stems.dictionary, sizes, pa.nulls(0))


def stem(tokens: Column) -> Column:
    """Stem every token of an ``array<string>`` column; a narrow Arrow step."""
    return F.arrow_udf(_stem_batch, "array<string>")(tokens)
