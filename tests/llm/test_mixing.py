import pytest
from pyspark.sql import functions as F

from trackstats.llm import mixing


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, cut = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in cut)
        parts = sum(weight[s] for s in sizes if s not in cut)
        share = {s: 2.0 * sizes[s] if s in cut else left * weight[s] / parts for s in sizes}
        over = {s for s in sizes if s not in cut and share[s] > 2 * sizes[s]}
        if not over:
            return share
        cut |= over


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target string, `class` string, level string")


def rows():
    out = [(i, "w " * (1 + i * i % 37), f"s{i % 7}" if i % 11 else None, "x", "y", None) for i in range(600)]
    return out + [(1000, "big " * 3000, "s1", None, None, None), (1001, None, "s1", "", "", ""), (1002, "", "only", "", "", ""),
                  (None, "no id here", "s2", "", "", ""), (5, "again " * 9, "s2", "", "", ""), (5, "again " * 9, "s2", "", "", "")]


def test_targets_and_taken(spark):
    data = rows()
    got = mixing.mixed(make(spark, data).repartition(4)).collect()
    assert len(got) == len(data)
    sizes = {}
    for _, text, source, *_ in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want, taken = brute_targets(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken.setdefault(r.source, []).append(r)
    for source, found in taken.items():
        # at most half of the document at the cut
        assert abs(sum(r.taken for r in found) - want[source]) <= max(r.size for r in found) / 2 + 1e-6


def test_same_again_whatever_the_partitions(spark):
    docs = make(spark, rows())
    a = sorted(map(str, mixing.mixed(docs.repartition(3)).collect()))
    assert a == sorted(map(str, mixing.mixed(docs.repartition(7)).collect()))


def test_mixture_repeats_rows_with_their_columns(spark):
    docs = make(spark, rows())
    made = mixing.mixture(docs)
    assert made.columns == docs.columns
    copies = {}
    for r in mixing.mixed(docs).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    found = {r.doc_id: r["count"] for r in made.groupBy("doc_id").count().collect()}
    assert found == {k: v for k, v in copies.items() if v}


def test_inclusion_is_close_to_its_probability(spark):
    docs = make(spark, [(i, "w " * 10 if i % 2 else "w " * 100, "s0" if i < 2000 else "s1", "", "", "") for i in range(4000)])
    found = mixing.mixed(docs, cycle=(1, 1), share=0.5).toPandas()
    short, long = (found[found["size"] == n].taken.gt(0).mean() for n in (10, 100))
    assert short / long == pytest.approx(2 ** (0.1 * 3), rel=0.1)  # three size classes apart


def test_a_very_long_text_and_clashing_names(spark):
    data = [(1, "w " * 120_000, "a", "t", "c", "l"), (2, "w " * 10, "a", None, None, None), (3, "w " * 130_000, "b", "t", "c", "l")]
    docs = make(spark, data).withColumn("row_number", F.lit("mine")).withColumn("copies", F.lit(9)).withColumn("size", F.lit(0.5))
    assert sorted(r.size for r in mixing.mixed(docs).collect()) == [10, 120_000, 130_000]
    made = mixing.mixture(docs)
    assert made.columns == docs.columns and {(r.row_number, r.copies, r["size"]) for r in made.collect()} == {("mine", 9, 0.5)}


def test_empty_table(spark):
    assert mixing.mixed(make(spark, [])).count() == 0
    assert mixing.mixture(make(spark, [(1, None, None, "", "", "")])).count() == 0
