"""Porter stemming written as regular expressions, to check the stemmer from SQL.

Works on a table of distinct tokens.  A leading ``y`` is a consonant and is
written ``Y`` while the rules run.
"""

from __future__ import annotations

from catalog.sql import quoted
from nearlex.functions.porter import _IRREGULAR, _STEP2, _STEP3, _STEP4

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"


def _m(stem: str, above: int) -> str:
    """Measure of ``stem`` exceeds ``above``."""
    body = f"{_V}{_C}" * above + f"{_V}[^aeiou]"
    return f"regexp_matches({stem}, '^({_C})?{body}')"


def _cut(word: str, n: int) -> str:
    return f"substr({word}, 1, length({word}) - {n})"


def _short(stem: str) -> str:
    """Ends consonant, vowel, consonant other than w, x, y; or is just vowel, consonant."""
    return (
        f"(regexp_matches({stem}, '([^aeiouy]|[aeiou]y)[aeiouy][^aeiouwxy]$') OR regexp_matches({stem}, '^[aeiou][^aeiou]$'))"
    )


def _mend(stem: str) -> str:
    double = f"(substr({stem}, -1) = substr({stem}, -2, 1) AND length({stem}) > 1 AND regexp_matches({stem}, '[^aeiou]$'))"
    return (
        f"CASE WHEN regexp_matches({stem}, '(at|bl|iz)$') THEN {stem} || 'e' "
        f"WHEN {double} THEN CASE WHEN regexp_matches({stem}, '[lsz]$') THEN {stem} ELSE {_cut(stem, 1)} END "
        f"WHEN {_m(stem, 0)} AND NOT {_m(stem, 1)} AND {_short(stem)} THEN {stem} || 'e' ELSE {stem} END"
    )


def _rules(rules, above: int = 0) -> str:
    """CASE arms, longest suffix first; a matched suffix ends the step."""
    arms = []
    for suffix, new in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        stem = _cut("w", len(suffix))
        arms.append(f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {_m(stem, above)} THEN {stem} || '{new}' ELSE w END")
    return " ".join(arms)


def _step(name: str, source: str, case: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT token, CASE {case} ELSE w END AS w FROM {source})"


def stems(words: str = "words", name: str = "stems") -> str:
    """CTEs from ``words(token)`` to ``name(token, stem)``."""
    ied = f"WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {_cut('w', 1)} ELSE {_cut('w', 2)} END"
    eed = f"WHEN w LIKE '%eed' THEN CASE WHEN {_m(_cut('w', 3), 0)} THEN {_cut('w', 1)} ELSE w END"
    past = " ".join(
        f"WHEN w LIKE '%{s}' AND regexp_matches({_cut('w', len(s))}, '[aeiouy]') THEN {_mend(_cut('w', len(s)))}"
        for s in ("ed", "ing")
    )
    logi = f"WHEN w LIKE '%logi' THEN CASE WHEN {_m(_cut('w', 3), 0)} THEN {_cut('w', 1)} ELSE w END"
    ion = _cut("w", 3)
    drop = [(s, "") for s in _STEP4 if s != "ion"]
    longest = sorted(drop, key=lambda r: -len(r[0]))
    four = " ".join(
        f"WHEN w LIKE '%{s}' THEN CASE WHEN {_m(_cut('w', len(s)), 1)} THEN {_cut('w', len(s))} ELSE w END"
        for s, _ in longest
    )
    four += f" WHEN w LIKE '%ion' THEN CASE WHEN {_m(ion, 1)} AND regexp_matches({ion}, '[st]$') THEN {ion} ELSE w END"
    e = _cut("w", 1)
    irregular = " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in _IRREGULAR.items())
    return ", ".join([
        f"p0 AS (SELECT token, CASE WHEN token LIKE 'y%' THEN 'Y' || substr(token, 2) ELSE token END AS w FROM {words} WHERE length(token) > 2)",
        _step("p1", "p0", f"WHEN w LIKE '%ies' AND length(w) = 4 THEN {_cut('w', 1)} WHEN w LIKE '%sses' OR w LIKE '%ies' THEN {_cut('w', 2)} "
              f"WHEN w LIKE '%ss' THEN w WHEN w LIKE '%s' THEN {_cut('w', 1)}"),
        _step("p2", "p1", f"{ied} {eed} {past}"),
        _step("p3", "p2", f"WHEN length(w) > 2 AND regexp_matches(w, '[^aeiou]y$') THEN {_cut('w', 1)} || 'i'"),
        _step("p4", "p3", f"WHEN w LIKE '%alli' AND {_m(_cut('w', 4), 0)} THEN {_cut('w', 2)}"),
        _step("p5", "p4", f"{logi} {_rules(_STEP2)}"),
        _step("p6", "p5", _rules(_STEP3)),
        _step("p7", "p6", four),
        _step("p8", "p7", f"WHEN w LIKE '%e' AND ({_m(e, 1)} OR ({_m(e, 0)} AND NOT {_short(e)})) THEN {e}"),
        _step("p9", "p8", f"WHEN w LIKE '%ll' AND {_m(e, 1)} THEN {e}"),
        f"{name} AS MATERIALIZED (SELECT token, CASE token {irregular} ELSE coalesce(lower(w), token) END AS stem FROM {words} LEFT JOIN p9 USING (token))",
    ])
