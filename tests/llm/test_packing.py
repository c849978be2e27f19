import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackstats.llm import packing as P
from trackstats.llm.vocabularies import END, encoding

ROWS = [(1, "Hello world, this is a text."), (2, None), (3, ""), (4, "longer " * 9000), (None, "no id"), (1, "Hello world, this is a text."),
        (5, "é ñ 漢字 \x00 \n\n\t tail "), *[(10 + i, "word " * (i % 90)) for i in range(300)]]


def texts(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, ids string")


def unpacked(rows):
    """Texts from packed rows (doc_ids, parts, cumulative lengths, ids)."""
    pieces = []
    for doc_ids, parts, ends, ids in rows:
        for d, p, a, b in zip(doc_ids, parts, ends[:-1], ends[1:], strict=True):
            pieces.append((d, p, ids[a:b].tolist()))
    return pieces


def texts_of(pieces, spark_rows):
    found = sorted(((d or 0, p, t) for d, p, t in pieces), key=lambda x: (x[0], x[1]))
    merged = {}
    for d, _, t in found:
        merged.setdefault(d, []).extend(t)
    want = {}
    for d, t in spark_rows:
        want.setdefault(d or 0, []).append(t or "")
    for d, wanted in want.items():
        ids = merged[d]
        assert ids.count(END) == len(wanted) and ids[-1] == END
        if len(wanted) == 1:
            assert encoding().decode(ids[:-1]) == wanted[0]


def test_rows_hold_every_text(spark):
    rows = P.packed(texts(spark).repartition(3), length=512).collect()
    for r in rows:
        ids = np.frombuffer(r.ids, np.uint16)
        assert len(ids) == 512 and r.n_tokens == r.cu_seqlens[-1] <= 512 and r.cu_seqlens[0] == 0
        assert r.resets == r.cu_seqlens[:-1] and (ids[r.n_tokens:] == END).all()
    texts_of(unpacked([(r.doc_ids, r.parts, r.cu_seqlens, np.frombuffer(r.ids, np.uint16)) for r in rows]), ROWS)


def test_files_hold_every_text(spark, tmp_path):
    rows = P.write_packed(texts(spark).repartition(3), f"file:{tmp_path}/p", length=256).collect()
    blocks = {}
    for r in rows:
        if r.file not in blocks:
            blocks[r.file] = P.read_block(open(r.file.removeprefix("file:"), "rb").read())
    got = []
    for r in rows:
        ids, ends, resets = blocks[r.file]
        assert ends[r.row].tolist() == r.cu_seqlens and resets[r.row].tolist() == r.resets
        got.append((r.doc_ids, r.parts, r.cu_seqlens, ids[r.row]))
    texts_of(unpacked(got), ROWS)


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.packed(empty).count() == 0
    assert P.write_packed(empty, f"file:{tmp_path}/p").count() == 0


@given(st.lists(st.integers(1, 40), max_size=80))
def test_best_fit_is_the_tightest_row(lengths):
    rows = P.best_fit_decreasing(np.array(lengths, int), 40)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    free = []  # brute force: the free lengths of the rows so far
    for need in sorted(lengths, reverse=True):
        fitting = [f for f in free if f >= need]
        best = min(fitting, default=None)
        if best is None:
            free.append(40 - need)
        else:
            free[free.index(best)] -= need
    assert sorted(free) == sorted(40 - sum(lengths[i] for i in r) for r in rows)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_holds_the_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    found = P.op2_packed_ids(spark, folder)
    want = {r.doc_id: len(encoding().encode_ordinary(r.text)) + 1 for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert found.agg(F.sum("n_tokens")).first()[0] == sum(want.values())
    assert {r.d for r in found.select(F.explode("doc_ids").alias("d")).collect()} == set(want)
