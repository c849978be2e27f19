import math
import os

import compare
import numpy as np
import pytest

from trackstats.llm import resident_codebooks as R
from trackstats.llm.registry import ORACLES, QUERIES


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain Lloyd with Python integers."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut[p]:
                groups.setdefault(near(x, books[p])[1], []).append(x)
            for e, xs in groups.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    out, by_label = [], {}
    for j, (i, _, label) in enumerate(kept):
        found = [near(cut[p][j], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    flat = ",".join(str(x) for b in books for c in b for x in c)
    import hashlib
    sha = hashlib.sha256(flat.encode()).hexdigest()
    return [(i, code, error, by_label[label], sha) for i, code, error, label in out], sha


def written(spark, tmp_path, rows, parts=3):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, error int, code string")
    docs.repartition(parts).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def test_equals_plain_lloyd_on_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(7)
    make = lambda: rng.normal(0, 0.3, 16).astype(np.float32).tolist()
    rows = [(i, make(), int(rng.integers(0, 4))) for i in range(20, 300)]
    hot = make()
    rows += [(1000 + i, hot, 2) for i in range(150)] + [(7, hot, None)] * 3 + [(None, make(), None), (None, make(), 1)]
    rows += [(1, None, 1), (2, [1.0] * 15 + [None], 1), (3, [float("nan")] + [0.0] * 15, 1), (4, [float("-inf")] + [0.0] * 15, None),
             (5, [-0.0001] * 16, 1), (6, [0.5] * 16, 1), (8, [1500.0] * 16, 9), (9, [-1500.25] * 16, 9)]
    want, _ = brute(rows)
    folder = written(spark, tmp_path, rows)
    assert rows_of(QUERIES["op11_vector_codes"](spark, folder)) == sorted(map(repr, want))


def test_fewer_rows_than_entries_and_none(spark, tmp_path):
    rows = [(3, [0.25] * 8, None), (1, [-0.25] * 8, None), (2, [0.25] * 8, 5)]
    got = rows_of(QUERIES["op11_vector_codes"](spark, written(spark, tmp_path / "few", rows)))
    assert got == sorted(map(repr, brute(rows)[0]))
    assert rows_of(QUERIES["op11_vector_codes"](spark, written(spark, tmp_path / "none", [(1, None, 2)], 1))) == []


def test_lengths_that_cannot_be_cut(spark):
    for vectors in ([[1.0] * 8, [1.0] * 16], [[1.0] * 12]):
        rows = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
        with pytest.raises(ValueError, match="equal parts"):
            R.compressed(rows)


def test_only_parts_that_change_entry_migrate(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(i, rng.normal(0, 1, 8).tolist(), 0) for i in range(2000)], "vec_id long, embedding array<float>, label int")
    moved = spark.sparkContext.accumulator(0)
    leaving = R._leaving

    def counted(books, owners, width):
        run = leaving(books, owners, width)

        def count(blocks):
            for owner, block in run(blocks):
                moved.add(len(R._unpacked(block, width)))
                yield owner, block
        return count
    monkeypatch.setattr(R, "_leaving", counted)
    partitions, updated = [], R._updated
    monkeypatch.setattr(R, "_updated", lambda books, members, owners: partitions.append(members.getNumPartitions()) or updated(books, members, owners))
    R.compressed(rows, parts=4)
    assert len(partitions) == R.ROUNDS and len(set(partitions)) == 1  # who stays is not copied to further partitions
    assert 0 < moved.value < 5 * 2000 * 4 / 2  # at most half of the parts a round, on average


def test_an_entry_with_all_members_is_spread_over_partitions():
    owners = R.Owners(16, 40)
    for position, entry in ((0, 0), (7, 15)):
        numbers = [owners.number(position, entry, s) for s in range(40)]
        assert [owners.split(n) for n in numbers] == [(position, entry, s) for s in range(40)]
        assert sorted(owners.partition(n) % 40 for n in numbers) == list(range(40))


def test_exact_beyond_the_precision_of_floats():
    members = np.array([[R.LARGEST, -R.LARGEST] * 8], np.int64)
    book = np.array([[-R.LARGEST, R.LARGEST] * 8, [-R.LARGEST + 1, R.LARGEST] * 8], np.int64)
    want = [sum((int(a) - int(b)) ** 2 for a, b in zip(members[0], c, strict=True)) for c in book]
    assert R._distances(members, book)[0].tolist() == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="given tables not present")
def test_equals_sql_on_given_vectors(spark):
    at = "/root/testdata/sf0.01"
    assert compare.difference(QUERIES["op11_vector_codes"](spark, at), compare.connect(at), ORACLES["op11_vector_codes"]) is None
