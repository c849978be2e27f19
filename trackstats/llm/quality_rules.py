"""Quality rules as weak supervision.

Every rule votes good or bad or abstains. Expectation-maximisation over the
counts of vote patterns estimates how each rule votes on good and on bad texts,
and the posterior probability of good decides, not the failure of a single rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .store import stored

WINDOW = 8
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(97, 123))
_STOP = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))
_CLOSING = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))
_WORDLY = W.PLAIN | _UPPER | np.isin(np.arange(256), np.frombuffer(b"'-", np.uint8))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct",
            "n_upper", "n_letters", "n_stops", "n_alpha", "n_clean"]


def _per_text(mask_places: np.ndarray, text_start: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(mask_places, text_start))


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts in ``MEASURES`` for every text."""
    w = W.Words(texts, lower=False)
    data, n, doc = w.data, len(texts), w.text_of()
    size = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = size[w.end] - size[w.start]
    whole = np.concatenate([[0], np.cumsum(chars)])

    line_end = np.flatnonzero(data == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    used = np.searchsorted(w.start, line_end) > np.searchsorted(w.start, line_start)
    line_start, line_end = line_start[used], line_end[used]
    line_doc = np.searchsorted(w.text_start, line_start, "right") - 1
    salt = W.mix(np.arange(n, dtype=W.U64) + W.U64(1))
    _, at = np.unique(W.span_hashes(data, line_start, line_end) ^ salt[line_doc], return_index=True)
    lines = np.bincount(line_doc, minlength=n)
    dup = lines - np.bincount(line_doc[at], minlength=n)

    h = w.hashes()
    own = W.mix(h ^ salt[doc])
    _, at = np.unique(own, return_index=True)
    distinct = np.bincount(doc[at], minlength=n)
    left = np.repeat(w.first[1:], w.count) - np.arange(len(h))
    start = np.flatnonzero(left >= WINDOW)
    total = np.zeros(len(start), W.U64)
    for j, m in enumerate(W._multipliers(WINDOW)):
        total += own[start + j] * m
    order = np.argsort(total)
    same = total[order[1:]] == total[order[:-1]]
    twice = np.zeros(len(start), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, start[twice], 1)
    np.add.at(cover, start[twice] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    last = data[w.end - 1]
    inside = lambda mask: (c := np.concatenate([[0], np.cumsum(mask[data])]))[w.end] - c[w.start]
    wordly, letters = inside(_WORDLY), inside(_LETTER | (np.arange(256) >= 128))
    clean = (wordly > 0) & (wordly + (_CLOSING[last] & ~_WORDLY[last]) == w.end - w.start)
    summed = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[w.first])
    return {"n_words": w.count, "word_chars": np.diff(whole[w.first]),
            "n_symbols": _per_text(np.flatnonzero(SYMBOLS[data]), w.text_start),
            "n_lines": lines, "n_dup_lines": dup, "n_repeat_words": np.diff(covered[w.first]), "n_distinct": distinct,
            "n_upper": _per_text(np.flatnonzero(_UPPER[data]), w.text_start),
            "n_letters": _per_text(np.flatnonzero(_LETTER[data]), w.text_start),
            "n_stops": summed(_STOP[last]), "n_alpha": summed(letters > 0), "n_clean": summed(clean)}


def _measured(batches):
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for at, chunk in W.text_chunks(texts):
            found = measure(chunk)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(chunk)), *[pa.array(found[m], pa.int64()) for m in MEASURES]],
                names=["doc_id", *MEASURES])


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts in ``MEASURES`` of every row; a null text has no words.

    Whole texts are read, a very long one in a chunk of its own; repeated rows and null doc_ids come back as often as they
    are there; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_measured, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def _vote(bad: Column, good: Column) -> Column:
    """0 bad, 1 good, 2 abstains."""
    return F.when(bad, 0).when(good, 1).otherwise(2)


def rules() -> dict[str, Column]:
    """The votes on a table of measures. Texts of under 10 words are too short for most rules."""
    c, words = F.col, F.col("n_words")
    enough = words >= 10
    return {
        "length": _vote(words < 5, words >= 50),
        "symbols": _vote(c("n_symbols") * 10 > words, enough & (c("n_symbols") * 50 < words)),
        "lines": _vote((c("n_dup_lines") >= 3) & (c("n_dup_lines") * 10 > c("n_lines") * 3), (c("n_lines") >= 3) & (c("n_dup_lines") == 0)),
        "repeats": _vote((c("n_repeat_words") >= 24) & (c("n_repeat_words") * 4 > words), enough & (c("n_repeat_words") * 50 <= words)),
        "word_length": _vote((c("word_chars") > 14 * words) | (c("word_chars") < 2 * words),
                             enough & (c("word_chars") >= 3 * words) & (c("word_chars") <= 10 * words)),
        "case": _vote(c("n_upper") * 2 > c("n_letters"), enough & (c("n_upper") * 5 < c("n_letters"))),
        "variety": _vote(enough & (c("n_distinct") * c("n_distinct") < 2 * words), enough & (c("n_distinct") * 5 >= words)),
        "sentences": _vote((words >= 40) & (c("n_stops") * 60 < words), (c("n_stops") * 30 >= words) & enough),
        "letters": _vote(c("n_alpha") * 10 < words * 8, enough & (c("n_alpha") * 20 > words * 19)),
        "plain_words": _vote(c("n_clean") * 2 < words, enough & (c("n_clean") * 10 > words * 9))}


def estimate(patterns: np.ndarray, counts: np.ndarray, *, rounds: int = 100, prior: float = 0.8) -> tuple[np.ndarray, float]:
    """Log odds of good that each rule's each vote adds, and the log prior odds.

    ``patterns`` has a row per vote pattern and a column per rule; at most
    3 ** rules rows whatever the number of texts. At the start a good text passes
    a rule in 95 cases of 100 and a bad one in 50, as it breaks some rules only;
    an abstention says nothing. In every round a good text breaks a rule in at
    most 2 cases of 100, so that no frequent kind of junk can pass for good.
    """
    n_rules = patterns.shape[1]
    onehot = np.stack([patterns == v for v in range(2)], axis=2).astype(float)
    like = np.empty((2, n_rules, 2))
    like[1], like[0] = (0.05, 0.95), (0.5, 0.5)
    for _ in range(rounds):
        weight = np.log(like[1]) - np.log(like[0])
        base = np.log(prior) - np.log1p(-prior)
        good = 1 / (1 + np.exp(-np.clip(base + (onehot * weight).sum((1, 2)), -500, 500)))
        for k, share in ((1, good), (0, 1 - good)):
            seen = np.einsum("p,prv->rv", counts * share, onehot) + 1.0
            like[k] = seen / seen.sum(1, keepdims=True)
        like[1, :, 0] = np.minimum(like[1, :, 0], 0.02)
        like[1, :, 1] = 1 - like[1, :, 0]
        prior = float(np.clip((counts @ good + 1) / (counts.sum() + 2), 1e-6, 1 - 1e-6))
    weight = np.log(like[1]) - np.log(like[0])
    # A rule never speaks against its own vote: bad cannot raise the odds, nor good lower them.
    weight[:, 0], weight[:, 1] = np.minimum(weight[:, 0], 0), np.maximum(weight[:, 1], 0)
    return np.hstack([weight, np.zeros((n_rules, 1))]), float(np.log(prior) - np.log1p(-prior))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``posterior`` (of good) and ``kept`` for every row.

    Repeated rows count as often as they occur. An empty table gives no rows. Very long texts are read to their end, other
    columns are not read. A posterior of exactly one half is good.
    """
    made = rules()
    found = stored(measures(docs), "measures")
    voted = found.withColumn("__votes", F.array(*made.values()))
    rows = voted.groupBy("__votes").count().collect()  # at most 3 ** rules rows
    patterns = np.array([r[0] for r in rows], int).reshape(-1, len(made))
    weight, base = estimate(patterns, np.array([r[1] for r in rows], float))
    odds = F.lit(base)
    for i in range(len(made)):
        odds = odds + F.element_at(F.array(*[F.lit(float(x)) for x in weight[i]]), F.col("__votes")[i] + 1)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (voted.withColumn("posterior", 1 / (1 + F.exp(-odds)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("posterior") >= 0.5)).drop("__votes"))


@query()
def op6_quality_rules(spark, folder):
    return judged(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
