import re

import numpy as np
import pytest

from trackstats.llm import quality_rules as Q

TEXTS = [
    None, "", " \n\t", "one", "É é\u00a0x #a", "a b c d e f g h " * 3, "word " * 25,
    "line one here\nline one here\nother\n \n \nline one here", "\n\n", "THIS!! IS!! LOUD!! " * 9,
    "Plain words make a sentence. They end well, as they should.\n" + " ".join(f"w{i}." for i in range(60)),
    "a|b <c> & $5 100% *x*", " ".join(f"q{i}" for i in range(5000)),
]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = {}
    for x in windows:
        seen[x] = seen.get(x, 0) + 1
    covered = {i + j for i, x in enumerate(windows) if seen[x] > 1 for j in range(8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def docs(spark, rows, **extra):
    return spark.createDataFrame(rows, "doc_id long, text string, posterior string, n_words string")


def test_measures_equal_brute_force(spark):
    rows = [(i, t, None, "x") for i, t in enumerate(TEXTS)] + [(None, "one", "x", None), (3, "one", "x", None)]
    got = Q.judged(docs(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "one" if r.doc_id is None else TEXTS[r.doc_id]
        want = brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept) and 0 <= r.posterior <= 1


def test_empty_table(spark):
    assert Q.judged(docs(spark, [])).count() == 0


def test_accuracies_are_found_without_labels():
    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.85
    votes = np.full((20000, 5), 2)
    for r, miss in enumerate((0.9, 0.8, 0.7, 0.5, 0.6)):  # how often a bad text breaks the rule
        voted = rng.random(20000) < 0.9
        broken = np.where(good, rng.random(20000) < 0.01, rng.random(20000) < miss)
        votes[:, r] = np.where(voted, np.where(broken, 0, 1), 2)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    weight, base = Q.estimate(patterns, counts.astype(float))
    odds = base + weight[np.arange(5), votes].sum(1)
    assert ((odds > 0) == good).mean() > 0.97


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_labelled_texts(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = Q.op6_quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    clean = found[(found.quality == 1) & ~found.base_failed]
    assert clean.kept.mean() > 0.99
    assert not found[found.quality == 0].kept.mean() > 0.05


def test_a_very_long_text(spark):
    text = " ".join(f"q{i}" for i in range(110_000)) + " the same eight words are said here twice" * 2
    got = Q.judged(docs(spark, [(1, text, "x", "y"), (2, "short", None, None)])).orderBy("doc_id").first()
    assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == brute(text)
