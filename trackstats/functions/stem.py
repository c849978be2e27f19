"""Porter's suffix-stripping algorithm (1980) with its common extensions, as column expressions.

The rules are data. A word has a shape of ``c`` and ``v`` for consonants and
vowels; a stem is a prefix of the word, so its shape is the same prefix of the
word's. Every step computes word and shape once and passes them on. Callers
aggregate to distinct words first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import once

# Words that bypass the rules.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Fixed values: (suffix, replacement), first match decides.
PLURAL = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
DERIVED = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
]
QUALITY = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
RESIDUAL = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: Column) -> Column:
    """``c`` for consonants and ``v`` for vowels; y is a vowel after a consonant."""
    def next_(shape: Column, ch: Column) -> Column:
        vowel = ch.isin(*"aeiou") | ((ch == "y") & shape.endswith("c"))
        return F.concat(shape, F.when(vowel, "v").otherwise("c"))
    return F.aggregate(F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)), F.lit(""), next_)


class _Stem:
    """The first ``n`` characters of the word ``__w`` with shape ``__s``."""

    def __init__(self, cut: int):
        n = F.length("__w") - cut
        self.text, self.shape = F.left("__w", n), F.left("__s", n)
        self.measure = F.regexp_count(self.shape, F.lit("vc"))
        self.short_end = (self.shape.endswith("cvc") & ~F.right(self.text, F.lit(1)).isin(*"wxy")) | (self.shape == "vc")


def _ends(suffix: str) -> Column:
    return F.endswith("__w", F.lit(suffix))


def _first_match(cases: list[tuple[Column, Column]]) -> Column:
    """The value of the first case that holds, else the word as it is."""
    out = None
    for when, value in cases:
        out = F.when(when, value) if out is None else out.when(when, value)
    return out.otherwise(F.col("__w"))


def _swap(rules, condition) -> Column:
    """The first suffix that matches decides; it is replaced if the stem meets the condition."""
    cases = []
    for suffix, replacement in rules:
        stem = _Stem(len(suffix))
        cases.append((_ends(suffix), F.when(condition(suffix, stem), F.concat(stem.text, F.lit(replacement))).otherwise(F.col("__w"))))
    return _first_match(cases)


def _plural() -> Column:
    short = _ends("ies") & (F.length("__w") == 4)
    return F.when(short, _Stem(1).text).otherwise(_swap(PLURAL, lambda s, stem: F.lit(True)))


def _past() -> Column:
    def bare(cut: int) -> Column:
        stem = _Stem(cut)
        last = F.right(stem.text, F.lit(1))
        double = (F.length(stem.text) > 1) & (last == F.left(F.right(stem.text, F.lit(2)), F.lit(1))) & stem.shape.endswith("c")
        restored = F.when(stem.text.endswith("at") | stem.text.endswith("bl") | stem.text.endswith("iz"), F.concat(stem.text, F.lit("e")))
        restored = restored.when(double, F.when(last.isin(*"lsz"), stem.text).otherwise(F.left(stem.text, F.length(stem.text) - 1)))
        restored = restored.when((stem.measure == 1) & stem.short_end, F.concat(stem.text, F.lit("e"))).otherwise(stem.text)
        return F.when(F.contains(stem.shape, F.lit("v")), restored).otherwise(F.col("__w"))
    return _first_match([
        (_ends("ied"), F.concat(_Stem(3).text, F.when(F.length("__w") == 4, "ie").otherwise("i"))),
        (_ends("eed"), F.when(_Stem(3).measure > 0, _Stem(1).text).otherwise(F.col("__w"))),
        (_ends("ed"), bare(2)), (_ends("ing"), bare(3))])


def _final_y() -> Column:
    stem = _Stem(1)
    return F.when(_ends("y") & (F.length("__w") > 2) & stem.shape.endswith("c"), F.concat(stem.text, F.lit("i"))).otherwise(F.col("__w"))


def _doubly_derived() -> Column:
    return F.when(_ends("alli") & (_Stem(4).measure > 0), _Stem(2).text).otherwise(F.col("__w"))


def _derived() -> Column:
    return _swap(DERIVED, lambda s, stem: (_Stem(len(s) - 1) if s == "logi" else stem).measure > 0)


def _quality() -> Column:
    return _swap(QUALITY, lambda s, stem: stem.measure > 0)


def _residual() -> Column:
    def allowed(suffix: str, stem: _Stem) -> Column:
        ok = stem.measure > 1
        return ok & (stem.text.endswith("s") | stem.text.endswith("t")) if suffix == "ion" else ok
    return _swap([(s, "") for s in RESIDUAL], allowed)


def _final_e() -> Column:
    bare = _Stem(1)
    return F.when(_ends("e") & ((bare.measure > 1) | ((bare.measure == 1) & ~bare.short_end)), bare.text).otherwise(F.col("__w"))


def _final_l() -> Column:
    return F.when(_ends("ll") & (_Stem(1).measure > 1), _Stem(1).text).otherwise(F.col("__w"))


STEPS = [_plural, _past, _final_y, _doubly_derived, _derived, _quality, _residual, _final_e, _final_l]


def porter(df: DataFrame, word: str, name: str) -> DataFrame:
    """``df`` with the stem of ``word`` in the column ``name``; NULL stays NULL.

    Words of up to two letters and irregular ones bypass the rules.
    """
    low = F.lower(F.col(word))
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    out = once(df, __low=low)
    out = once(out, __known=F.try_element_at(irregular, F.col("__low")), __w=F.col("__low"))
    for step in STEPS:
        out = once(once(out, __s=_shape(F.col("__w"))), __next=step())
        out = out.drop("__w", "__s").withColumnRenamed("__next", "__w")
    stem = F.coalesce("__known", F.when(F.length("__low") <= 2, F.col("__low")).otherwise(F.col("__w")))
    return out.withColumn(name, stem).select(*df.columns, name)
