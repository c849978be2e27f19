import re

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline as P
from trackstats.llm import mixing, quality_model
from trackstats.llm.store import stored
from trackstats.llm.vocabularies import END, encoding

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.encode().lower().decode())
    return {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return bool(a & b) and 100 * len(a & b) >= 80 * len(a | b)


def test_every_stage_on_all_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, made = docs.columns, [docs]
    for name, stage in P.STAGES:
        made.append(stored(stage(spark, made[-1], FOLDER), name))
    assert all(d.columns == columns for d in made[1:-1])
    start, scored, unique, clean, mixture, packed = ([r.asDict() for r in d.collect()] for d in made)
    ids = lambda rows: {r["doc_id"] for r in rows}

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = {r.doc_id for r in quality_model.scored(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).where("score >= 0.5").collect()}
    assert ids(scored) == good and len(scored) == len(good)
    right = [(r["doc_id"] in good) == (labels[r["doc_id"]] > 0) for r in start if r["doc_id"] in labels]
    assert np.mean(right) > 0.9

    sets = {r["doc_id"]: shingles(r["text"]) for r in scored}
    near = {i: {j for j in sets if j != i and alike(sets[i], sets[j])} for i in sets}
    seen, want = set(), set()
    for i in sorted(sets):
        if i not in seen:
            want.add(i)
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in seen:
                    seen.add(j)
                    todo += near[j]
    assert ids(unique) == want and len(unique) == len(want)

    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert ids(clean) == {r["doc_id"] for r in unique if not any(t in r["text"] for t in items)}

    taken = {r.doc_id: r.copies for r in mixing.mixed(made[3]).collect()}
    count = {}
    for r in mixture:
        count[r["doc_id"]] = count.get(r["doc_id"], 0) + 1
    assert count == {i: n for i, n in taken.items() if n}

    texts, found = {r["doc_id"]: r["text"] for r in clean}, {}
    for r in packed:
        ids_ = np.frombuffer(r["ids"], np.uint16)
        for d, p, a, b in zip(r["doc_ids"], r["parts"], r["cu_seqlens"][:-1], r["cu_seqlens"][1:], strict=True):
            found.setdefault(d, []).append((p, ids_[a:b].tolist()))
    assert set(found) == set(count)
    for d, pieces in found.items():
        if count[d] == 1:
            tokens = [t for _, piece in sorted(pieces) for t in piece]
            assert tokens[-1] == END and encoding().decode(tokens[:-1]) == texts[d]
        assert sum(piece.count(END) for _, piece in pieces) == count[d]


def test_stages_take_empty_tables_and_rows_without_id(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "some words without an id", None, None, None), (None, None, None, "s", 0), (1, None, "en", "s", 0), (2, "", "en", "s", 0),
            (3, "a text of a few plain words that nobody has seen before.", "en", None, 56)]
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema)
        for _, stage in P.STAGES:
            docs = stored(stage(spark, docs, FOLDER))
        assert docs.columns[0] == "block" and docs.count() <= len(rows)


def test_registered_and_optional():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_query_gives_packed_rows(spark):
    found = P.run(spark, FOLDER)
    assert found.agg(F.sum(F.size("doc_ids"))).first()[0] > 0
