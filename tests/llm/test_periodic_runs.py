import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackstats.llm import periodic_runs as P


def brute(words):
    """All runs, by comparing every word with the one q before it, for every q."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s + q
            while e < n and words[e] == words[e - q]:
                e += 1
            if e - s >= max(6, 4 * q) and (s, e) not in found:
                found[s, e] = q
            s = max(s + 1, e - q + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def by_operator(texts):
    return [(runs, text.decode()) for runs, text in P._found([t.encode() for t in texts])]


def periodic(rng, n, letters):
    words = [rng.choice(letters) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(n)
        q = rng.randrange(1, max(2, (n - a) // 4))
        for i in range(a + q, min(n, a + q * rng.randrange(3, 9) + rng.randrange(q))):
            words[i] = words[i - q]
    return words


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdefghijklmnop"])
def test_equals_brute_force(letters):
    rng = random.Random(letters)
    docs = [periodic(rng, rng.randrange(1, 200), letters) for _ in range(150)]
    for words, (runs, text) in zip(docs, by_operator([" ".join(w) for w in docs]), strict=True):
        assert runs == brute(words)
        assert text == collapsed(words, runs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=70), max_size=4))
def test_equals_brute_force_on_short_texts(docs):
    assert [r for r, _ in by_operator([" ".join(w) for w in docs])] == [brute(w) for w in docs]


@pytest.mark.parametrize("unit", ["a", "ab", "aab", "aaaaaaaab", "aaaaaaaaaaaabaaab", "abaababaabaab"])
def test_runs_within_runs(unit):
    words = list("x" + unit * 9 + unit[:2] + "y" + unit * 4 + "z" + unit[::-1] * 5)
    assert by_operator([" ".join(words)])[0][0] == brute(words)


def test_a_sequence_that_defeats_hashes_modulo_powers_of_two():
    words = ["ab"[bin(i).count("1") & 1] for i in range(1 << 12)]
    words = words + list("ba" * 10) + words[:1024] * 4
    ids = np.array([ord(w) for w in words])
    got = P.find_runs(ids, np.array([0, len(ids)]))
    found = list(zip(*[x.tolist() for x in got], strict=True))
    assert (len(words) - 4096, 4096, 1024) in [(s + n - 4096, 4096, q) for s, n, q in found if q == 1024]
    assert all(np.array_equal(ids[s:s + n - q], ids[s + q:s + n]) for s, n, q in found)


def test_wavelet_matrix_and_suffix_array():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 300):
        ids = rng.integers(0, 3, n)
        first = np.array([0, n // 3, n // 3, n])
        sa = P.SuffixArray(ids, first)
        suffix = [(int(np.searchsorted(first, i, "right")), *ids[i:first[first > i].min()].tolist()) for i in range(n)]
        assert sa.order.tolist() == sorted(range(n), key=lambda i: suffix[i])
        tree = P.WaveletMatrix(sa.order, max(1, (n - 1).bit_length()))
        lo = rng.integers(0, n, 50)
        hi = lo + rng.integers(1, n + 1, 50)
        hi = np.minimum(hi, n)
        x = rng.integers(0, n + 3, 50)
        assert tree.below(lo, hi, np.minimum(x, 1 << tree.bits)).tolist() == [int((sa.order[a:b] < y).sum()) for a, b, y in zip(lo, hi, x, strict=True)]
        k = rng.integers(0, hi - lo)
        assert tree.smallest(lo, hi, k).tolist() == [sorted(sa.order[a:b])[j] for a, b, j in zip(lo, hi, k, strict=True)]
        for j, (start, a, b) in enumerate(sa.levels):
            for s, u, v in zip(start, a, b, strict=True):
                same = [i for i in range(n) if suffix[i][:1 + 2 ** j] == suffix[s][:1 + 2 ** j]]
                assert sorted(sa.order[u:v]) == same


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), collapsed(words, runs))]
    return (doc_id, len(runs), *(best if best else (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def test_query_on_edge_rows(spark, tmp_path):
    from trackstats.llm.registry import QUERIES
    rng = random.Random(5)
    rows = [(i, " ".join(periodic(rng, rng.randrange(1, 150), "abcdefgé"))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "x " * 40), (None, "z " * 9), (None, None), (7, "y z " * 8), (7, "y z " * 8)]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, runs int, best string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(expected(*r)) for r in rows)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op13_periodic_runs"](spark, f"{tmp_path}/none").count() == 0


def test_a_very_long_text():
    rng = random.Random(1)
    words = [f"w{rng.randrange(3000)}" for _ in range(150_000)]
    for i in range(20_000 + 7_777, 20_000 + 5 * 7_777):
        words[i] = words[i - 7_777]
    words[100_000:100_050] = ["same"] * 50
    runs, text = by_operator([" ".join(words)])[0]
    assert [(n, q) for _, n, q in runs if q in (1, 7_777) and n > 20] == [(n, q) for n, q in [(38_885, 7_777), (50, 1)]]
    assert text == collapsed(words, runs)
