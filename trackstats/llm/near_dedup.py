"""MinHash near-duplicates with odd sketches.

Every text gets ``SAMPLES`` MinHash samples of its word shingles. Bands of the
first of them bring candidates together; all of them folded into a parity bitmap
(odd sketch) estimate the similarity of two candidates from the population count
of the XOR of their bitmaps; what the estimate leaves is confirmed on full
shingle sets. Nodes of the graph are doc_ids.

No bucket is paired with itself. Exact copies are one node. In the first round
the smallest node of every bucket is its hub and meets the other members. In each
later round some hubs, from the bucket's smallest components, meet the members of
other components: the hubs wait in memory while the members stream past, and only
links come out. A bucket is done when its members that have not been hubs are
all in one component. So no true link between two components is lost, and a
group of a million copies costs a million comparisons, not their square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import lookup
from . import words as W
from .graph import components
from .registry import query, table
from .store import stored

#: P(a pair at similarity s shares a band) = 1 - (1 - s**ROWS)**BANDS: all but 1e-5 of the pairs at 0.8.
BANDS, ROWS = 28, 5
#: At a similarity of 0.8 the estimate's standard deviation is below 0.022.
SAMPLES, BITS = 512, 1024
#: Hubs of a bucket in each round after the first, and members that one task compares with them, about.
HUBS, SLICE = 256, 1024
#: Estimates this far below the threshold are dropped unconfirmed (over four standard deviations).
MARGIN = 0.1

_SEED = W.mix(np.arange(1, SAMPLES + 1, dtype=W.U64) * W.U64(0xA24BAED4963EE407))
_MULT = (_SEED >> W.U64(32)).astype(np.uint32) | np.uint32(1)
_XOR = _SEED.astype(np.uint32)

SIGNATURE = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def _samples(sh: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash samples, one row per sample, of consecutive non-empty runs of hashes."""
    x = (sh >> W.U64(32)).astype(np.uint32)
    out = np.empty((SAMPLES, len(starts)), np.uint32)
    for p in range(SAMPLES):
        out[p] = np.minimum.reduceat((x ^ _XOR[p]) * _MULT[p], starts)
    return out


def _band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.empty((BANDS, samples.shape[1]), W.U64)
    for b in range(BANDS):
        key = np.full(samples.shape[1], b + 1, W.U64)
        for row in samples[b * ROWS:(b + 1) * ROWS]:
            key = W.mix(key * W.U64(0x9E3779B97F4A7C15) + row.astype(W.U64))
        keys[b] = key
    return keys


def _odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, ``BITS / 64`` words per text."""
    n = samples.shape[1]
    odd = np.zeros(n * BITS, bool)
    base = np.arange(n) * BITS
    for p in range(SAMPLES):  # one sample sets one bit of a text, so no place occurs twice
        bit = W.mix(samples[p].astype(W.U64) + (W.U64(p + 1) << W.U64(32))) % W.U64(BITS)
        odd[base + bit.astype(np.int64)] ^= True
    return np.packbits(odd.reshape(n, BITS), axis=1, bitorder="little").view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    """128 bits over a set of 64-bit hashes."""
    other = W.mix(s ^ W.U64(0x5851F42D4C957F2D))
    return np.array([W.mix(s).sum(dtype=W.U64) + W.U64(len(s)), other.sum(dtype=W.U64)], W.U64).tobytes()


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.reshape(-1)))


def _signatures(k: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for at, chunk in W.text_chunks(texts):
                sh, first = W.shingles(W.Words(chunk), k)
                n = len(chunk)
                sets = [np.unique(sh[first[i]:first[i + 1]]) for i in range(n)]
                full = np.flatnonzero(np.diff(first) > 0)
                bands = np.zeros((n, BANDS), W.U64)
                odd = np.zeros((n, BITS // 64), np.int64)
                if len(full):
                    samples = _samples(sh, first[:-1][full])
                    bands[full] = _band_keys(samples).T
                    odd[full] = _odd_sketch(samples)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, n), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    _lists(W.signed(bands)), _lists(odd)], names=["doc_id", "n_shingles", "digest", "bands", "sketch"])
    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for at, chunk in W.text_chunks(texts):
                sh, first = W.shingles(W.Words(chunk), k)
                sets = [np.unique(sh[first[i]:first[i + 1]]) for i in range(len(chunk))]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, len(chunk)), pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([W.signed(s) for s in sets], pa.list_(pa.int64())),
                    pa.array([np.unique((s >> W.U64(32)).astype(np.uint32)).tobytes() for s in sets])],
                    names=["doc_id", "digest", "members", "short"])
    return run


def _meetings(percent: int):
    """Links between the hubs of a bucket (``kind`` 0) and the members (``kind`` 1) that follow them."""
    def run(batches):
        at, hubs, sketches = None, [], None
        for batch in batches:
            found = []
            for bucket, part, kind, doc, component, sketch, short in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (bucket, part) != at:
                    at, hubs, sketches = (bucket, part), [], None
                own = np.array(sketch, np.int64).view(W.U64), np.frombuffer(short, np.uint32)
                if kind == 0:
                    hubs.append((doc, component, *own))
                    continue
                if sketches is None:
                    sketches, components = np.array([h[2] for h in hubs]), np.array([h[1] for h in hubs])
                flips = np.bitwise_count(sketches ^ own[0]).sum(1)
                close = np.flatnonzero((flips <= _most_flips(percent)) & (components != component))
                if not len(close):
                    continue
                others = [hubs[i][3] for i in close]
                size = np.fromiter(map(len, others), np.int64, len(others))
                every = np.concatenate(others)
                place = np.minimum(np.searchsorted(own[1], every), len(own[1]) - 1)
                same = np.add.reduceat(own[1][place] == every, np.cumsum(size) - size, dtype=np.int64)
                # Halves of two hashes may agree by chance, once in millions: the full sets decide.
                linked = 100 * (same + 2) >= percent * (len(own[1]) + size - same - 2)
                found += [(max(doc, hubs[i][0]), min(doc, hubs[i][0])) for i in close[linked]]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def _id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _most_flips(percent: int) -> int:
    return int((1 - np.exp((percent / 100 - MARGIN - 1) * 4 * SAMPLES / BITS)) * BITS / 2)


def _columns(prefix: str) -> list[Column]:
    """The words of the sketch as columns of their own, which compile to a few instructions each."""
    return [F.col("sketch")[i].alias(f"{prefix}{i}") for i in range(BITS // 64)]


def _may_be_similar(a: str, b: str, percent: int) -> Column:
    """Whether two odd sketches are close enough: 1 + BITS / (4 SAMPLES) ln(1 - 2 flips / BITS) is the estimate."""
    flips = sum(F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(BITS // 64))
    return flips <= _most_flips(percent)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    same = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * same >= percent * (F.size("sa") + F.size("sb") - same)).select("a", "b")


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Rows with the same doc_id are one document, linked with each other. A row
    without doc_id is linked with nothing, has a null component and is kept. A
    text without words (null included) has the empty set and is linked with
    nothing. Other columns are not read.
    """
    sigs = stored(_id_and_text(docs).mapInArrow(_signatures(k), SIGNATURE), "signatures")
    named = sigs.where("doc_id is not null and digest is not null")
    groups = (named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1").drop("copies"))
    placed = lookup(named, groups, ["digest"], "left")
    links = placed.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    rows = placed.where("rep is null or doc_id = rep").select("doc_id", F.explode("bands").alias("bucket"))
    shared = (rows.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("other"))
              .where("hub <> other").select("bucket", "hub"))
    sketches = placed.where("rep is null or doc_id = rep").select("doc_id", "sketch")
    members = stored(lookup(rows, shared, ["bucket"], "inner").distinct(), "members")
    inside = stored(members.select("doc_id").distinct().join(sketches, "doc_id")
                    .dropDuplicates(["doc_id"]), "sketches")
    candidates = _id_and_text(docs).join(inside.select("doc_id"), "doc_id", "left_semi")
    sets = stored(candidates.mapInArrow(_sets(k), "doc_id long, digest binary, members array<long>, short binary")
                  .where("digest is not null").groupBy("doc_id", "digest")
                  .agg(F.first("members").alias("members"), F.first("short").alias("short")).drop("digest"), "sets")

    pairs = members.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    probe = inside.select(F.col("doc_id").alias("a"), *_columns("x"))
    against = inside.select(F.col("doc_id").alias("b"), *_columns("y"))
    pairs = (pairs.join(against, "b").join(probe, "a")
             .where(_may_be_similar("x", "y", percent)).select("a", "b"))
    edges = links.unionByName(_confirmed(pairs, sets, percent))
    comps = stored(components(edges), "components", narrow=True)

    seen = inside.join(sets.select("doc_id", "short"), "doc_id")
    left = members.where("doc_id <> hub").select("bucket", "doc_id")
    while True:
        at = (left.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")))
        mixed = at.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                         F.ceil(F.count(F.lit(1)) / SLICE).alias("slices")).where("lo <> hi")
        left = stored(lookup(at, mixed.select("bucket", "slices"), ["bucket"], "inner"), "open", narrow=True)
        if left.isEmpty():
            break
        sizes = left.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
        order = Window.partitionBy("bucket").orderBy("size", "component", "doc_id")
        chosen = stored(lookup(left, sizes, ["bucket", "component"], "inner").withColumn("place", F.row_number().over(order))
                        .where(F.col("place") <= HUBS).drop("place", "size"), "hubs", narrow=True)
        hubs = chosen.select("bucket", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
                             F.lit(0).alias("kind"), "doc_id", "component")
        rows = left.select("bucket", F.pmod(F.xxhash64("doc_id"), F.col("slices")).alias("slice"), F.lit(1).alias("kind"),
                           "doc_id", "component")
        met = (hubs.unionByName(rows).join(seen, "doc_id")
               .select("bucket", "slice", "kind", "doc_id", "component", "sketch", "short")
               .repartition("bucket", "slice").sortWithinPartitions("bucket", "slice", "kind"))
        pairs = met.mapInArrow(_meetings(percent), "a long, b long").distinct()
        new = stored(_confirmed(pairs, sets, percent), "links", narrow=True)
        left = left.select("bucket", "doc_id").join(chosen.select("bucket", "doc_id"), ["bucket", "doc_id"], "left_anti")
        if not new.isEmpty():
            merged = comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new)
            comps = stored(components(merged), "components", narrow=True)

    found = sigs.select("doc_id", "n_shingles").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component, with all its columns.

    Rows without doc_id stay as they are; of rows with the same doc_id one stays.
    """
    kept = near_duplicates(docs, k=k, percent=percent).where("kept and doc_id is not null").select("doc_id").distinct()
    own = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return own.select(*docs.columns).unionByName(docs.where("doc_id is null"))


@query(r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(ws) - 3, 1)), lambda i: array_to_string(list_slice(ws, i + 1, i + 4), ' '))) AS s
  FROM w WHERE len(ws) > 0),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * common >= 80 * (p.n + q.n - common)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT a, y FROM reach JOIN edge ON b = x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN size USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)""")
def op10_near_duplicates(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), k=4)
