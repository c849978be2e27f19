"""Quality classifier on random-indexing word vectors.

Every unit (a word, or a run of marks) has a sparse random index vector. A
unit's context vector is the sum of the index vectors of its neighbours over the
whole corpus; units share ``BUCKETS`` hashed rows, so the table has a fixed size.
A document is the mean and the spread of its units' vectors, and how alike
neighbouring vectors are. A two-layer network
is trained on labelled documents and its probabilities are calibrated with a
temperature on labelled documents it has not seen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .store import stored
from .tables import PARTS, parts, summed

BUCKETS, DIMENSIONS = 1 << 14, 64
#: Neighbours on each side.
REACH = 2
#: Labelled documents that the network learns from, at most: those with the smallest hash.
LABELLED = 20_000
HIDDEN, EPOCHS, RATE = 32, 60, 0.01
FEATURES = 2 * DIMENSIONS + 5

_WORDLY = np.zeros(256, bool)
_WORDLY[48:58] = _WORDLY[65:91] = _WORDLY[97:123] = _WORDLY[128:] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SEEDS = W.mix(np.arange(1, BUCKETS + 1, dtype=W.U64))
#: Index vectors: +1 at one place and -1 at another.
_PLUS = (_SEEDS % W.U64(DIMENSIONS)).astype(np.int64)
_MINUS = (_PLUS + 1 + (_SEEDS >> W.U64(32)).astype(np.int64) % (DIMENSIONS - 1)) % DIMENSIONS


def units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the units of some texts and where each text's begin; words in capitals are units of their own."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text_start = np.concatenate([[0], np.cumsum(size)])
    kind = np.where(_WORDLY[raw], 2, np.where(W.NOT_SPACE[raw], 1, 0)).astype(np.int8)
    kind[text_start[1:] - 1] = 0
    edge = np.flatnonzero(np.diff(kind, prepend=np.int8(0), append=np.int8(0)) != 0)
    begin, stop = edge[:-1], edge[1:]
    used = kind[begin] > 0 if len(begin) else np.zeros(0, bool)
    begin, stop = begin[used], stop[used]
    capitals = np.concatenate([[0], np.cumsum(_CAPITAL[raw])])
    shouted = (capitals[stop] - capitals[begin]) * 2 > np.maximum(stop - begin, 3)
    h = W.span_hashes(W.LOWER[raw], begin, stop) ^ np.where(shouted, W.U64(0x9E3779B97F4A7C15), W.U64(0))
    return (W.mix(h) % W.U64(BUCKETS)).astype(np.int64), np.searchsorted(begin, text_start)


def _contexts(batches):
    """The task's sums of neighbours' index vectors, with the units counted in a last column."""
    total = np.zeros(BUCKETS * (DIMENSIONS + 1))
    for batch in batches:
        for _, chunk in W.text_chunks(batch.column(0).to_pylist()):
            b, first = units(chunk)
            owner = np.repeat(np.arange(len(chunk)), np.diff(first))
            cells, signs = [b * (DIMENSIONS + 1) + DIMENSIONS], [np.ones(len(b))]
            for reach in range(1, REACH + 1):
                near = owner[reach:] == owner[:-reach]
                left, right = b[:-reach][near], b[reach:][near]
                for one, other in ((left, right), (right, left)):
                    row = one * (DIMENSIONS + 1)
                    cells += [row + _PLUS[other], row + _MINUS[other]]
                    signs += [np.ones(len(row)), -np.ones(len(row))]
            total += np.bincount(np.concatenate(cells), np.concatenate(signs), len(total))
    grouped = total.reshape(BUCKETS // 64, -1)
    made = parts(grouped.astype(np.int32))
    used = np.flatnonzero(grouped.any(1))
    yield made.take(pa.array(used))


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Unit-length vectors of all buckets, as many numbers whatever the corpus.

    Sums are damped by their logarithm and the corpus mean is taken out, which
    otherwise is the direction of the most frequent neighbours.
    """
    sums = summed(texts.mapInArrow(_contexts, PARTS), (BUCKETS // 64, 64 * (DIMENSIONS + 1)), np.int32)
    sums = sums.reshape(BUCKETS, DIMENSIONS + 1)
    vectors, count = sums[:, :-1], sums[:, -1:]
    vectors = np.sign(vectors) * np.log1p(np.abs(vectors))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
    vectors -= (vectors * count).sum(0) / max(count.sum(), 1)
    return (vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9)).astype(np.float32)


def _pooled(vectors):
    def run(batches):
        known = np.frombuffer(vectors.value, np.float32).reshape(BUCKETS, DIMENSIONS)
        for batch in batches:
            for at, chunk in W.text_chunks(batch.column(1).to_pylist()):
                b, first = units(chunk)
                n = np.diff(first)
                out = np.zeros((len(chunk), FEATURES), np.float32)
                full = np.flatnonzero(n > 0)
                if len(full):
                    rows, starts = known[b], first[:-1][full]
                    mean = np.add.reduceat(rows, starts, axis=0) / n[full, None]
                    # Likeness of neighbours, and how many of the units differ: repetition shows in both.
                    near = np.zeros(len(rows), np.float32)
                    near[:-1] = np.einsum("ij,ij->i", rows[1:], rows[:-1])
                    near[first[1:][full] - 1] = 0
                    out[full, -5] = np.add.reduceat(near, starts) / n[full]
                    owner = np.repeat(np.arange(len(chunk)), n)
                    kinds = np.unique(owner * BUCKETS + b)
                    out[full, -4] = np.bincount(kinds // BUCKETS, minlength=len(chunk))[full] / n[full] ** 0.75
                    rows *= rows
                    square = np.add.reduceat(rows, starts, axis=0) / n[full, None]
                    out[full, :DIMENSIONS] = mean
                    out[full, DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(square - mean * mean, 0))
                    out[full, -3] = np.linalg.norm(mean, axis=1)
                    out[full, -2] = np.abs(mean).max(1)
                out[:, -1] = np.log1p(n) / 10
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(chunk)), pa.array([r.tobytes() for r in out.astype(np.float16)])],
                                                 names=["doc_id", "features"])
    return run


class Network:
    """tanh layer, logistic output, temperature."""

    def __init__(self, inputs: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.p = [rng.normal(0, inputs ** -0.5, (inputs, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.mean, self.scale, self.temperature = np.zeros(inputs), np.ones(inputs), 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 1):
        """Adam on mini-batches, a little weight decay."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x, rng = (x - self.mean) / self.scale, np.random.default_rng(seed)
        m, v, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for epoch in range(EPOCHS):
            order, rate = rng.permutation(len(x)), RATE * (1 - epoch / EPOCHS)
            for at in range(0, len(x), 128):
                i = order[at:at + 128]
                h = np.tanh(x[i] @ self.p[0] + self.p[1])
                error = (1 / (1 + np.exp(-np.clip(h @ self.p[2] + self.p[3], -500, 500))) - y[i]) / len(i)
                back = error[:, None] * self.p[2] * (1 - h * h)
                grads = [x[i].T @ back + 1e-4 * self.p[0], back.sum(0), h.T @ error + 1e-4 * self.p[2], error.sum(keepdims=True)]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray):
        """The temperature of the smallest log loss; a single label would have none and keeps 1."""
        if 0 < y.sum() < len(y):
            z = self.logits(x)
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
            loss = [np.logaddexp(0, np.where(y > 0, -z, z) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])


def learned(features: np.ndarray, labels: np.ndarray) -> Network:
    """Four rows of five train the network, the fifth sets its temperature. Without labels it says 0.5."""
    net = Network(FEATURES)
    if not len(labels):
        net.p[2][:] = 0
        return net
    fifth = np.arange(len(labels)) % 5 == 4
    net.fit(features[~fifth].astype(float), labels[~fifth])
    net.calibrate(features[fifth].astype(float), labels[fifth])
    return net


def remainder(key: str, by: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % by


def scored(docs: DataFrame, labels: DataFrame, *, held_out: Column | None = None, at_most: int = LABELLED) -> DataFrame:
    """``doc_id, held_out, score`` for every row of ``docs``: the probability of quality 1.

    Labels are taken from rows of ``labels`` (``doc_id, quality``) that are not
    held out, by default those with crc32(doc_id) mod 3 of 1. Rows without label
    or doc_id are scored only. Conflicting labels of a document count as its
    highest. Null texts are empty and are scored like empty ones.
    """
    spark = docs.sparkSession
    out = F.coalesce(remainder("doc_id", 3) == 1 if held_out is None else held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    vectors = spark.sparkContext.broadcast(word_vectors(rows.select("text")).tobytes())  # 4 MB
    pooled = stored(rows.mapInArrow(_pooled(vectors), "doc_id long, features binary"), "features")
    known = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("quality").alias("quality")))
    sample = (pooled.where("doc_id is not null").where(~out).join(known, "doc_id")
              .orderBy(F.xxhash64("doc_id"), "features").limit(at_most).select("features", "quality").toArrow())
    x = np.array([np.frombuffer(f, np.float16) for f in sample.column("features").to_pylist()]).reshape(-1, FEATURES)
    net = learned(x, (np.array(sample.column("quality").to_pylist(), float) > 0).astype(float))

    def run(batches):
        for batch in batches:
            data = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float16).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.probability(data.astype(float)))], names=["doc_id", "score"])
    return pooled.mapInArrow(run, "doc_id long, score double").select("doc_id", out.alias("held_out"), "score")


def without_rejected(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with their columns; rows without doc_id stay.

    Rows that share a doc_id stay together if one of them reaches it.
    """
    good = scored(docs, labels).where((F.col("score") >= threshold) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    own = docs.where("doc_id is not null").join(good, "doc_id", "left_semi").select(*docs.columns)
    return own.unionByName(docs.where("doc_id is null"))


@query()
def op5_quality_scores(spark, folder):
    found = scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
