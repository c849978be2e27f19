import zlib

import numpy as np

from trackstats.llm import quality_model as Q


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, quality string, score string, features string")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = Q.op5_quality_scores(spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id) and found.score.between(0, 1).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    assert (found.predicted == (found.score >= 0.5)).all()
    known = found.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_held_out_labels_are_not_read(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    changed = labels.withColumn("quality", Q.F.when(Q.remainder("doc_id", 3) == 1, 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    a = {r.doc_id: r.score for r in Q.scored(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in Q.scored(docs, changed).collect()}


def test_edge_rows(spark):
    rows = [(1, None, "x", "y", "z"), (2, "", "", "", ""), (3, " \n", "", "", ""), (None, "words without id", "", "", ""),
            (4, "twice", "", "", ""), (4, "twice", "", "", ""), (5, "long text " * 200_000, "", "", ""), (6, "!!", "", "", "")]
    labels = spark.createDataFrame([(1, 0, 1), (4, 1, 0), (4, 0, 0), (None, 1, 0), (99, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.scored(make(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    kept = Q.without_rejected(make(spark, rows), labels)
    assert kept.columns == make(spark, rows).columns
    none = labels.where("false")
    assert {r.score for r in Q.scored(make(spark, rows), none).collect()} == {0.5}
    assert Q.scored(make(spark, []), labels).count() == 0


def test_context_vectors_equal_brute_force(spark):
    rows = [b"the cat sat on the mat !! THE CAT", b"", b"one", b"the cat sat on the mat again and again"]
    df = spark.createDataFrame([(r,) for r in rows], "text binary").repartition(2)
    sums = Q.summed(df.mapInArrow(Q._contexts, Q.PARTS), (Q.BUCKETS // 64, 64 * (Q.DIMENSIONS + 1)), np.int32).reshape(Q.BUCKETS, -1)
    want = np.zeros_like(sums)
    for r in rows:
        b, _ = Q.units([r])
        for i, x in enumerate(b):
            want[x, -1] += 1
            for j in range(max(0, i - Q.REACH), min(len(b), i + Q.REACH + 1)):
                if j != i:
                    want[x, Q._PLUS[b[j]]] += 1
                    want[x, Q._MINUS[b[j]]] -= 1
    assert (sums == want).all()


def test_temperature_mends_overconfidence():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, Q.FEATURES))
    y = (rng.random(4000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = Q.Network(Q.FEATURES)
    net.logits = lambda z: 4 * z[:, 0]
    net.calibrate(x, y)
    assert 3 < net.temperature < 5.5


def test_features_hold_64_dimensions_in_half_precision(spark):
    assert Q.DIMENSIONS == 64 and Q.FEATURES == 133
    texts = spark.createDataFrame([(1, b"the cat sat on the mat")], "doc_id long, text binary")
    vectors = Q.word_vectors(texts.select("text"))
    assert vectors.shape == (Q.BUCKETS, 64)
    found = texts.mapInArrow(Q._pooled(spark.sparkContext.broadcast(vectors.tobytes())), "doc_id long, features binary").first()
    assert len(found.features) == 2 * 133
