"""The stemmer word by word in plain Python, to compare the column expressions with."""

from trackstats.functions.stem import DERIVED, IRREGULAR, PLURAL, QUALITY, RESIDUAL


def _shape(word: str) -> str:
    """``c`` for consonants and ``v`` for vowels; y is a vowel after a consonant."""
    shape = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).replace("vv", "v").count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _swap(word: str, rules, condition) -> str:
    for suffix, replacement in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + replacement if condition(suffix, stem) else word
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-3] + ("ie" if len(word) == 4 else "i")
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            break
    else:
        return word
    if "v" not in _shape(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _derive(word: str) -> str:
    while word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    return _swap(word, DERIVED, lambda s, stem: _measure(stem + "l" if s == "logi" else stem) > 0)


def stem_word(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    if word.endswith("ies") and len(word) == 4:
        word = word[:-1]
    else:
        word = _swap(word, PLURAL, lambda s, stem: True)
    word = _past(word)
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        word = word[:-1] + "i"
    word = _derive(word)
    word = _swap(word, QUALITY, lambda s, stem: _measure(stem) > 0)
    word = _swap(word, [(s, "") for s in RESIDUAL],
                 lambda s, stem: _measure(stem) > 1 and (s != "ion" or stem.endswith(("s", "t"))))
    if word.endswith("e"):
        bare = word[:-1]
        m = _measure(bare)
        if m > 1 or (m == 1 and not _short_end(bare)):
            word = bare
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word
