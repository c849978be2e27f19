"""Licence scans with a positional index of rare words.

The index holds, for every word of a template, the templates and positions where
it stands. How rare a word is comes from its document frequency over the whole
corpus. A template can only reach its share of weight if one of its rarest words
is there (those that weigh more than what may be missing), so a text's
highest-IDF licence words are looked up first, and only where their postings
point are the other words of a template looked at. Postings are intersected by
relative position: a word at place i that stands at position p of a template
votes for a start at i - p, and votes at most ``slack`` words apart count
together, so words may be inserted or missing. The template counts if the words
found have its share of the weight and each mandatory key phrase stands in full
near the same start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table

# Phrases that give a label wherever their words stand consecutively.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label, words of a notice or header, the key phrases in it that must stand in full.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at http www apache org licenses license 2 0", ["apache license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["hereby granted", "free of charge"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction", ["hereby granted", "deal in the software"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
     ["must retain the above copyright notice"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", ["copy modify and or distribute"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3.0", "gnu general public license as published by either version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "gnu general public license as published by either version 2", ["gnu general public license", "version 2"]),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
     ["gnu general public license", "version 3"]),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
     ["gnu general public license", "version 2"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["affero general public license"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file",
     ["mozilla public license"]),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", ["eclipse public license"]),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ["boost software license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ["cc by nd 4 0"]),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike 4 0"]),
]
# Identifiers that follow "SPDX-License-Identifier", and their labels.
IDENTIFIERS = {"apache 2 0": "apache-2.0", "mit": "mit", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "isc": "isc", "gpl 2 0": "gpl-2.0",
               "gpl 3 0": "gpl-3.0", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "agpl 3 0": "agpl", "mpl 2 0": "mpl-2.0", "epl 2 0": "epl-2.0",
               "bsl 1 0": "bsl-1.0", "unlicense": "unlicense", "cc0 1 0": "cc0-1.0", "cc by 4 0": "cc-by-4.0", "cc by sa 4 0": "cc-by-sa-4.0"}
SPDX = "spdx license identifier"
#: Share of a template's inverse document frequency that must be found.
SHARE = 0.6
#: Votes for a start count together up to a quarter of a template's words apart; an identifier may stand within an expression.
LOOSE, EXPRESSION = 4, 6


def notices() -> list[tuple[str, str, list[str]]]:
    return NOTICES + [(label, f"{SPDX} {words}", [SPDX, words]) for words, label in IDENTIFIERS.items()]


def _hashes(phrase: str) -> np.ndarray:
    return W.Words([phrase.encode()], W.PLAIN).hashes()


def vocabulary() -> np.ndarray:
    phrases = [*BASE, *[words for _, words, _ in notices()]]
    return np.unique(np.concatenate([_hashes(p) for p in phrases]))


def _inside(words: np.ndarray, phrase: np.ndarray) -> int:
    """Where the phrase stands in the words."""
    return next(i for i in range(len(words)) if np.array_equal(words[i:i + len(phrase)], phrase))


class Template:
    """A notice: its words and their weights, which of them are looked up first, its key phrases and their positions."""

    def __init__(self, label: str, phrase: str, keys: list[str], idf: dict[int, float]):
        self.label, self.words = label, _hashes(phrase)
        self.weight = np.array([idf[int(h)] for h in self.words])
        self.slack = EXPRESSION if phrase.startswith(SPDX) else max(2, len(self.words) // LOOSE)
        self.keys = [(_inside(self.words, k), k) for k in map(_hashes, keys)]
        # Without all of these words, less than the share is left.
        order = np.argsort(-self.weight, kind="stable")
        enough = np.cumsum(self.weight[order]) > (1 - SHARE) * self.weight.sum() + 1e-9
        self.rare = np.unique(self.words[order[:int(np.argmax(enough)) + 1]])
        by_word = np.argsort(self.words, kind="stable")
        self.sorted, self.positions = self.words[by_word], by_word


def templates(idf: dict[int, float]) -> list[Template]:
    return [Template(label, p, keys, idf) for label, p, keys in notices()]


class Index:
    """Postings of the words looked up first: word -> templates."""

    def __init__(self, known: list[Template]):
        self.templates = known
        words = np.concatenate([t.rare for t in known])
        owner = np.repeat(np.arange(len(known)), [len(t.rare) for t in known])
        order = np.argsort(words, kind="stable")
        self.words, self.owner = words[order], owner[order]

    def lookup(self, h: np.ndarray) -> list[np.ndarray]:
        """For every template the places of ``h`` where a word stands that is looked up for it."""
        low, high = np.searchsorted(self.words, h, "left"), np.searchsorted(self.words, h, "right")
        at = np.flatnonzero(high > low)
        n = (high - low)[at]
        posting = np.repeat(low[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner, place = self.owner[posting], np.repeat(at, n)
        order = np.argsort(owner, kind="stable")
        return np.split(place[order], np.searchsorted(owner[order], np.arange(1, len(self.templates))))


def _phrase_places(h: np.ndarray, text: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where the phrase's words stand consecutively within one text."""
    at = np.flatnonzero(h[:len(h) - len(phrase) + 1] == phrase[0]) if len(h) >= len(phrase) else np.zeros(0, np.int64)
    for j in range(1, len(phrase)):
        at = at[h[at + j] == phrase[j]]
    return at[text[at] == text[at + len(phrase) - 1]]


def _near(sorted_: np.ndarray, at: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
    return np.searchsorted(sorted_, at - slack, "left"), np.searchsorted(sorted_, at + slack, "right")


def find(t: Template, h: np.ndarray, text: np.ndarray, first: np.ndarray, rare: np.ndarray, step: int = 1 << 14):
    """Text, start (from its first word, perhaps before it) and share of every place of the template.

    ``h`` are the words of all texts and ``text`` says whose they are, ``first`` where each begins, ``rare`` where the words
    stand that are looked up first. Of starts at most ``slack`` apart the best is given, of equals the first.
    """
    reach = len(t.words) + 2 * t.slack
    mark = np.zeros(len(h) + 1, np.int64)
    np.add.at(mark, np.maximum(rare - reach, first[text[rare]]), 1)
    np.add.at(mark, np.minimum(rare + reach + 1, first[text[rare] + 1]), -1)
    place = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    low, high = np.searchsorted(t.sorted, h[place], "left"), np.searchsorted(t.sorted, h[place], "right")
    n = high - low
    position = t.positions[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    place = np.repeat(place, n)
    apart = len(h) + 2 * reach  # between the starts of two texts
    start = text[place] * apart + place - position
    order = np.argsort(start, kind="stable")
    start, position = start[order], position[order]
    centre = np.unique(start)
    for offset, key in t.keys:
        at = _phrase_places(h, text, key)
        low, high = _near(np.sort(text[at] * apart + at - offset), centre, t.slack)
        centre = centre[high > low]
    share = np.zeros(len(centre))
    for at in range(0, len(centre), step):
        low, high = _near(start, centre[at:at + step], t.slack)
        n = high - low
        vote = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        met = np.unique(np.repeat(np.arange(len(n)), n) * len(t.words) + position[vote])  # a position counts once
        share[at:at + step] = np.bincount(met // len(t.words), t.weight[met % len(t.words)], len(n))
    share /= t.weight.sum()
    good = share >= SHARE - 1e-9
    centre, share = centre[good], share[good]
    if not len(centre):
        return []
    group = np.cumsum(np.diff(centre, prepend=centre[0]) > t.slack)
    best = np.lexsort((centre, -share, group))
    best = best[np.unique(group[best], return_index=True)[1]]
    own = (centre[best] + reach) // apart
    return list(zip(own.tolist(), (centre[best] - own * apart - first[own]).tolist(), share[best].tolist(), strict=True))


def _document_counts(batches):
    """How many texts of the task hold each licence word."""
    known = vocabulary()
    counts, texts = np.zeros(len(known), np.int64), 0
    for batch in batches:
        for _, chunk in W.text_chunks(batch.column(0).to_pylist()):
            w = W.Words(chunk, W.PLAIN)
            h = w.hashes()
            place = np.clip(np.searchsorted(known, h), 0, len(known) - 1)
            hit = known[place] == h
            pairs = np.unique(w.text_of()[hit] * len(known) + place[hit])
            counts += np.bincount(pairs % len(known), minlength=len(known))
            texts += len(chunk)
    yield pa.RecordBatch.from_arrays(
        [pa.array([*W.signed(known), 0]), pa.array([*counts, texts])], names=["word", "n"])


def rarity(texts: DataFrame) -> dict[int, float]:
    """Inverse document frequency of every licence word over all rows of ``texts`` (one binary column)."""
    rows = (texts.mapInArrow(_document_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .collect())  # one row per word of the vocabulary
    found = {r.word: r.n for r in rows}
    total = found.pop(0, 0)
    return {int(h): float(np.log((total + 1) / (found.get(int(W.signed(h[None])[0]), 0) + 1)) + 1) for h in vocabulary()}


OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
       "score double, places array<struct<label:string,start:long,share:double>>")


def _scan(idf: dict[int, float]):
    index = Index(templates(idf))
    base = [(label, _hashes(p)) for p, label in BASE.items()]

    def run(batches):
        for batch in batches:
            for offset, chunk in W.text_chunks(batch.column(1).to_pylist()):
                w = W.Words(chunk, W.PLAIN)
                h, text, n = w.hashes(), w.text_of(), len(chunk)
                n_base, first, last = np.zeros(n, np.int64), [None] * n, [None] * n
                found: list[list] = [[] for _ in range(n)]
                base_labels: list[set] = [set() for _ in range(n)]
                for label, phrase in base:
                    for at in _phrase_places(h, text, phrase).tolist():
                        d = int(text[at])
                        s = at - int(w.first[d])
                        found[d].append({"label": label, "start": s, "share": 1.0})
                        n_base[d] += 1
                        first[d] = s if first[d] is None else min(first[d], s)
                        last[d] = s if last[d] is None else max(last[d], s)
                        base_labels[d].add(label)
                for t, rare in zip(index.templates, index.lookup(h), strict=True):
                    if len(rare):
                        for d, s, x in find(t, h, text, w.first, rare):
                            found[d].append({"label": t.label, "start": s, "share": x})
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(offset, n), pa.array(w.count, pa.int64()), pa.array(n_base),
                    pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                    pa.array([",".join(sorted(x)) for x in base_labels]),
                    pa.array([",".join(sorted({y["label"] for y in x})) for x in found]),
                    pa.array([min(1.0, max((y["share"] for y in x), default=0.0)) for x in found], pa.float64()),
                    pa.array([sorted(x, key=lambda y: (y["start"], y["label"], y["share"])) for x in found], PLACES)],
                    names=[c.split()[0] for c in OUT.split(", ")])
    return run


PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))


def licence_scan(docs: DataFrame) -> DataFrame:
    """A row for every row of ``docs`` (``doc_id, text``): word count, base phrases, labels, score and all places.

    ``score`` is the highest share of a notice found, 0 without any. A null or
    empty text has no words and no labels. A notice's words may be partly
    missing, its start may then lie before the first word. Whole texts are read,
    very long ones in a chunk of their own. Repeated rows and null doc_ids come
    back as often as they are there and count as often in the document
    frequencies; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_scan(rarity(rows.select("text"))), OUT)


@query()
def op4_licence_scan(spark, folder):
    return licence_scan(table(spark, folder, "documents")).drop("places")
