import re

import compare
import numpy as np
import pytest

from trackstats.llm import near_dedup
from trackstats.llm.registry import ORACLES


def brute(rows, k, percent):
    sets = {}
    for i, text in rows:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def fixture():
    base = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(base).upper()), (3, "\t".join(base) + " tail")]
    rows += [(10 + j, " ".join([*base[:30], f"changed{j}", *base[31:]])) for j in range(20)]
    # a chain: each close to the next, the ends far apart
    rows += [(100 + j, " ".join(f"c{i}" for i in range(3 * j, 3 * j + 60))) for j in range(12)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, "é É"), (207, "É é")]
    # a shared passage in otherwise different texts
    rows += [(300 + j, " ".join([f"p{i}" for i in range(25)] + [f"own{j}x{i}" for i in range(25)])) for j in range(30)]
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_equals_brute_force(spark, k):
    rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {tuple(r) for r in near_dedup.near_duplicates(docs, k=k).collect()}
    assert got == brute(rows, k, 80)


def test_rows_without_id_repeated_rows_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, "x"), (None, text, "y"), (5, text, "z"), (5, text, "z"), (7, text, None), (8, "other", "bands")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string").withColumn("digest", docs_extra())
    got = near_dedup.near_duplicates(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [
        (None, None, True), (None, None, True), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True)]
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 5, 8]


def docs_extra():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"v{i % 5000}q{i}" for i in range(120_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "short text here now ok")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_estimate_is_close():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1200, dtype=np.int64).view(np.uint64)
    a, b = pool[:1000], pool[111:1111]  # similarity 889/1111 = 0.8
    odd = near_dedup._odd_sketch(near_dedup._samples(np.concatenate([a, b]), np.array([0, 1000])))
    flips = sum(int(x).bit_count() for x in (odd[0] ^ odd[1]).view(np.uint64))
    assert abs(1 + near_dedup.BITS / (4 * near_dedup.SAMPLES) * np.log(1 - 2 * flips / near_dedup.BITS) - 0.8) < 0.05


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = near_dedup.op10_near_duplicates(spark, folder)
    assert compare.difference(found, compare.connect(folder), ORACLES["op10_near_duplicates"]) is None
