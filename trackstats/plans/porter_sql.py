"""Porter stemming as plain SQL over the table ``counts``, the check for the stemmer.

Each step is one derived table over (word, w); ``shape`` spells a text in c and v.
"""

from __future__ import annotations

from ..functions import stem as P


def _shape(expr: str) -> str:
    """Vowels to v, the rest to c; y is a vowel after a consonant, left to right."""
    s = f"regexp_replace(regexp_replace({expr}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    for _ in range(4):  # settles runs of up to four y
        s = f"regexp_replace(regexp_replace({s}, '(^|V)y', '\\1C'), 'Cy', 'CV')"
    return s


def _measure(expr: str) -> str:
    return f"len(regexp_extract_all({_shape(expr)}, 'V+C'))"


def _short(expr: str) -> str:
    return f"(({_shape(expr)} SIMILAR TO '.*CVC' AND right({expr}, 1) NOT IN ('w', 'x', 'y')) OR {_shape(expr)} = 'VC')"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _rules(rules, condition) -> str:
    out = "CASE"
    for suffix, replacement in rules:
        stem = _cut(len(suffix))
        then = f"concat({stem}, '{replacement}')"
        test = condition(suffix, stem)
        out += f" WHEN ends_with(w, '{suffix}') THEN " + (f"CASE WHEN {test} THEN {then} ELSE w END" if test else then)
    return out + " ELSE w END"


def _past() -> str:
    def after(n: int) -> str:
        s = _cut(n)
        return f"""CASE WHEN NOT contains({_shape(s)}, 'V') THEN w
  WHEN right({s}, 2) IN ('at', 'bl', 'iz') THEN concat({s}, 'e')
  WHEN length({s}) > 1 AND right({s}, 1) = left(right({s}, 2), 1) AND ends_with({_shape(s)}, 'C')
    THEN CASE WHEN right({s}, 1) IN ('l', 's', 'z') THEN {s} ELSE {_cut(n + 1)} END
  WHEN {_measure(s)} = 1 AND {_short(s)} THEN concat({s}, 'e') ELSE {s} END"""
    return f"""CASE WHEN ends_with(w, 'ied') THEN concat({_cut(3)}, CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END)
  WHEN ends_with(w, 'eed') THEN CASE WHEN {_measure(_cut(3))} > 0 THEN {_cut(1)} ELSE w END
  WHEN ends_with(w, 'ed') THEN {after(2)} WHEN ends_with(w, 'ing') THEN {after(3)} ELSE w END"""


_STEPS = [
    f"CASE WHEN ends_with(w, 'ies') AND length(w) = 4 THEN {_cut(1)} ELSE {_rules(P.PLURAL, lambda s, t: None)} END",
    _past(),
    f"CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND right({_shape(_cut(1))}, 1) = 'C' THEN concat({_cut(1)}, 'i') ELSE w END",
    f"CASE WHEN ends_with(w, 'alli') AND {_measure(_cut(4))} > 0 THEN {_cut(2)} ELSE w END",
    _rules(P.DERIVED, lambda s, t: f"{_measure(_cut(3) if s == 'logi' else t)} > 0"),
    _rules(P.QUALITY, lambda s, t: f"{_measure(t)} > 0"),
    _rules([(s, "") for s in P.RESIDUAL],
           lambda s, t: f"{_measure(t)} > 1" + (f" AND right({t}, 1) IN ('s', 't')" if s == "ion" else "")),
    f"""CASE WHEN ends_with(w, 'e') AND ({_measure(_cut(1))} > 1
  OR ({_measure(_cut(1))} = 1 AND NOT {_short(_cut(1))})) THEN {_cut(1)} ELSE w END""",
    f"CASE WHEN ends_with(w, 'll') AND {_measure(_cut(1))} > 1 THEN {_cut(1)} ELSE w END",
]

_IRREGULAR = ", ".join(f"('{w}', '{s}')" for w, s in P.IRREGULAR.items())

STEMS = "s0 AS MATERIALIZED (SELECT DISTINCT word, word AS w FROM counts), " + ", ".join(
    f"s{i + 1} AS MATERIALIZED (SELECT word, {step} AS w FROM s{i})" for i, step in enumerate(_STEPS)
) + f""", irregular(word, stem) AS (VALUES {_IRREGULAR}),
stems AS (SELECT s.word, CASE WHEN i.stem IS NOT NULL THEN i.stem WHEN length(s.word) <= 2 THEN s.word ELSE s.w END AS stem
  FROM s{len(_STEPS)} s LEFT JOIN irregular i ON s.word = i.word)"""
