import collections
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from trackstats.llm import brown as B

TEXTS = [None, "", " ", "One two three two", "ONE Two", "é É x y", "z " * 3000, *[f"the {a} {b} sat" for a in ("cat", "dog") for b in ("big", "red")]] * 3


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, word string, block string, n string")


def run(spark, rows, **options):
    rule = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return B.language_scores(docs(spark, rows).repartition(3), held_out=rule, rounds=2, **options).collect()


def test_base_equals_brute_force(spark):
    rows = [(i, t, "w", "b", "n") for i, t in enumerate(TEXTS)] + [(None, "no id", "", "", ""), (4, "ONE Two", "", "", "")]
    tokens = [[*(t or "").encode().lower().split(), None] for _, t, *_ in rows]
    counts = collections.Counter(x for (i, *_), w in zip(rows, tokens, strict=True) if not held(i) for x in w)
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter((i, held(i), len(w), sum(x in counts for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
                               for (i, *_), w in zip(rows, tokens, strict=True))
    got = run(spark, rows)
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.perplexity >= 1 for r in got)


def test_no_training_rows_and_empty_table(spark):
    ids = [i for i in range(200) if held(i)][:4]
    got = run(spark, [(i, "some words", "", "", "") for i in ids])
    assert len(got) == 4 and {(r.n_known, r.train_tokens) for r in got} == {(0, 0)} and all(math.isfinite(r.score) for r in got)
    assert run(spark, []) == []


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    types = np.concatenate([rng.integers(0, 30, B.CLASSES), [1, 0]]).astype(float)
    in_class = types * 5
    counts = rng.integers(0, 50, (B._STATES, B._STATES)).astype(float)
    p = 10 ** B.transition_scores(counts, in_class, types)
    words = np.where(in_class[:B.CLASSES] > 0, (in_class[:B.CLASSES] - B.DISCOUNT * types[:B.CLASSES]) / np.maximum(in_class[:B.CLASSES], 1), 0)
    assert np.allclose(p[:, :B.CLASSES] @ words + p[:, B._END_CLASS] + p[:, B._UNSEEN], 1)


def counted_words(spark, rows):
    texts = docs(spark, rows).select(F.col("text").cast("binary").alias("text"))
    common = spark.sparkContext.broadcast(B.common_words(texts))
    counted = texts.mapInArrow(B._count(common), B.PACKED).repartition("word_group").mapInArrow(B._merge, B.COUNTED)
    return common, counted.mapInArrow(B._only_common(common), B.COUNTED).cache()


def key(word):
    return B.W.Words([word.encode()]).hashes()[0]


def test_exchange_finds_two_languages(spark):
    rng = np.random.default_rng(5)
    vocab = [[f"{c}{i}" for i in range(600)] for c in "ab"]
    rows = [(i, " ".join(rng.choice(vocab[i % 2], 100)), "", "", "") for i in range(500)]
    common, counted = counted_words(spark, rows)
    classes, history = B.cluster(counted, common)
    kinds = np.array([[np.sum(classes[np.searchsorted(common.value, [key(w) for w in v])] == c) for c in range(B.CLASSES)] for v in vocab])
    assert kinds.sum() == len(common.value) == 1200 and kinds.max(0).sum() > 0.95 * 1200  # classes of one language
    got = run(spark, rows)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_likelihood_never_falls_and_bigrams_are_those_of_the_texts(spark):
    rng = np.random.default_rng(11)
    topic = [rng.permutation(2000)[:400] for _ in range(5)]
    rows = [(i, " ".join(f"w{x}" for x in rng.choice(topic[i % 5], 150)), "", "", "") for i in range(200)]
    common, counted = counted_words(spark, rows)
    classes, history = B.cluster(counted, common)
    found = [B.likelihood(x) for x in history]
    assert len(found) > 2 and all(a <= b for a, b in zip(found, found[1:], strict=False)) and found[-1] > found[0] + 1000
    want = np.zeros((B._STATES, B._STATES))
    of = lambda w: int(classes[np.searchsorted(common.value, key(w))])
    for _, text, *_ in rows:
        seq = [B._END_CLASS, *map(of, text.split()), B._END_CLASS]
        for x, y in zip(seq, seq[1:], strict=False):
            want[x, y] += 1
    assert np.array_equal(history[-1], want)


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 12, 400)
    words[rng.integers(0, 400, 60)] = 3
    words[::37] = -1  # END
    classes = rng.integers(0, 5, 12)

    def table(of):
        out = np.zeros((B._STATES, B._STATES))
        seq = [B._END_CLASS if w < 0 else of[w] for w in [-1, *words, -1]]
        for x, y in zip(seq, seq[1:], strict=False):
            out[x, y] += 1
        return out
    bigrams = table(classes)
    seq = [-1, *words.tolist(), -1]
    near, n, twice = np.zeros((12, 2, B._STATES)), np.zeros(12), np.zeros(12)
    for i, w in enumerate(seq):
        if w >= 0:
            n[w] += 1
            for side, v in ((0, seq[i - 1]), (1, seq[i + 1])):
                near[w, side, B._END_CLASS if v < 0 else classes[v]] += 1
            twice[w] += seq[i - 1] == w
    gain = B.gains(near, n, classes, twice, bigrams)
    for w in range(12):
        for c in (0, 1, 4, 9):
            moved = classes.copy()
            moved[w] = c
            assert np.isclose(gain[w, c] - gain[w, classes[w]], B.likelihood(table(moved)) - B.likelihood(bigrams))


def test_rarer_words_and_their_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) % 500), "", "", "") for i in range(120)]
    monkeypatch.setattr(B, "FLUSH", 200)
    common, counted = counted_words(spark, rows)
    texts = [w for r in rows for w in r[1].split()]
    assert 0 < len(common.value) < len(set(texts)) and counted.count() == len(common.value)
    classes, history = B.cluster(counted, common, 2)
    known = set(common.value.tolist())
    of = lambda w: int(classes[np.searchsorted(common.value, key(w))]) if int(key(w)) in known else B._RARE
    want = np.zeros((B._STATES, B._STATES))
    for _, text, *_ in rows:
        seq = [B._END_CLASS, *map(of, text.split()), B._END_CLASS]
        for x, y in zip(seq, seq[1:], strict=False):
            want[x, y] += x < B.CLASSES or y < B.CLASSES
    assert np.array_equal(history[-1], want)
    got = run(spark, rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got) and len(got) == 120


def test_classes_and_rounds():
    assert (B.CLASSES, B.ROUNDS) == (64, 8)


def test_held_out_texts_score_better_than_the_base(spark):
    found = B.op8_language_scores(spark, "/root/testdata/sf0.01").toPandas()
    out = found[found.held_out]
    assert out.score.sum() > 0.9 * out.base_score.sum()
    tokens = out.n_tokens.sum()
    print("held-out perplexity", 10 ** (-out.score.sum() / tokens), "of single words", 10 ** (-out.base_score.sum() / tokens))


def test_rows_alike_are_dealt_by_where_they_are_read(spark):
    rows = [(None, "", "", "", "")] * 50 + [(7, "same words here", "", "", "")] * 50
    got = run(spark, rows)
    assert len(got) == 100 and {r.n_tokens for r in got} == {1, 4}


def test_a_very_long_text(spark):
    text = "one two three four five " * 30_000
    got = run(spark, [(1, text, "", "", ""), (2, "one two", "", "", "")])
    assert sorted(r.n_tokens for r in got) == [3, 150_001] and all(math.isfinite(r.score) for r in got)
