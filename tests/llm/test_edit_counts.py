from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackstats.llm import edit_counts as E
from trackstats.llm.vocabularies import encoding

PIECES = st.sampled_from(["the ", "word", " ", "  ", "\n", "\n\n ", "'s", "'re", "é", "漢字", "12 ", "3", ".", "!! ", "\t", " ", "don't ", "a b c "])
TEXT = st.lists(PIECES, max_size=60).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 200), st.integers(0, 30), TEXT), max_size=5))
def test_counts_equal_a_full_count(text, edits):
    encode = encoding().encode_ordinary
    old, E.RUN = E.RUN, 8
    cuts = E.cuts
    try:
        E.cuts = lambda t: cuts(t, 8)
        tree = E.build(text, encode)
        assert tree.tokens[1] == len(encode(text))
        for start, n, insert in edits:
            a = min(start, len(text))
            text = text[:a] + insert + text[min(start + n, len(text)):]
            E.apply(tree, start, start + n, insert, encode)
            assert tree.text() == text
            assert tree.tokens[1] == len(encode(text)) and tree.chars[1] == len(text)
    finally:
        E.RUN, E.cuts = old, cuts


def test_only_touched_runs_are_encoded():
    encode, text = encoding().encode_ordinary, "plain words follow each other here " * 20_000
    tree = E.build(text, encode)
    again = E.apply(tree, 350_000, 350_010, "other", encode)
    assert tree.tokens[1] == len(encode(tree.text())) and again < 4 * E.RUN


def test_edits_that_change_the_number_of_runs_leave_other_leaves_alone():
    encode, text = encoding().encode_ordinary, "plain words follow each other here " * 20_000
    tree = E.build(text, encode)
    leaves, built = list(tree.leaves), []
    tree._build = lambda rows: built.append(rows)
    again = E.apply(tree, 350_000, 350_010, "many more words " * 60, encode)
    again += E.apply(tree, 200_000, 202_000, "", encode)
    changed = sum(a is not b for a, b in zip(leaves, tree.leaves, strict=True))
    assert not built and changed < 20 and again < 8 * E.RUN + 1000
    want = text[:350_000] + "many more words " * 60 + text[350_010:]
    want = want[:200_000] + want[202_000:]
    assert tree.text() == want and tree.tokens[1] == len(encode(want)) and tree.chars[1] == len(want)


def test_many_edits_of_one_place():
    encode, text = encoding().encode_ordinary, "some words to begin with here " * 50
    tree = E.build(text, encode)
    for i in range(200):
        E.apply(tree, 300, 300, f" number {i} was put in", encode)
        text = text[:300] + f" number {i} was put in" + text[300:]
    assert tree.text() == text and tree.tokens[1] == len(encode(text)) and max(map(len, tree.leaves)) <= E.CountTree.FULL
    for _ in range(40):
        E.apply(tree, 0, 500, "", encode)
        text = text[500:]
        assert tree.text() == text and tree.tokens[1] == len(encode(text))


def test_columns_of_clashing_names(spark):
    docs = spark.createDataFrame([(1, "some text", 5, "x")], "doc_id long, text string, n_tokens int, n_before string")
    kept = E.counted(docs).withColumn("n_edits", F.lit(7)).withColumn("edits", F.from_json(F.lit('[{"start":0,"stop":4,"insert":"more"}]'), E.EDIT))
    got = E.edited(kept).first()
    assert (got.text, got.n_edits, got.n_before) == ("more text", 1, 2)


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", [(0, 0, "new text here")]), (3, "gone", [(0, 99, None)]), (None, "one two", [(3, 3, "x"), (0, 1, "O")]),
            (4, "again", []), (4, "again", []), (5, "word " * 50_000, [(100_000, 100_001, " é ")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,stop:int,insert:string>>")
    kept = E.counted(docs).withColumn("edits", F.when(F.col("doc_id") == 2, F.from_json(F.lit('[{"start":0,"stop":0,"insert":"new text here"}]'), E.EDIT))
                                      .when(F.col("doc_id") == 3, F.from_json(F.lit('[{"start":0,"stop":99}]'), E.EDIT))
                                      .when(F.col("doc_id") == 5, F.from_json(F.lit('[{"start":100000,"stop":100001,"insert":" é "}]'), E.EDIT)))
    got = E.edited(kept).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens == len(encoding().encode_ordinary(r.text)) and sum(r.run_chars) == len(r.text)
    by = {r.doc_id: r for r in got}
    assert by[1].text == "" and by[2].text == "new text here" and by[3].text == "" and by[5].text[100_000:100_003] == " é "
    assert E.edited(E.counted(docs.where("false")).withColumn("edits", F.lit(None))).count() == 0


def test_query_equals_a_full_count(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in E.op3_edited_token_counts(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        text = r.text + f"\nend of document {r.doc_id}"
        m = len(r.text) // 2
        text = "A headline: " + text[:m] + "(20 characters went here)" + text[m + 20:]
        found = got[r.doc_id]
        assert (found.n_before, found.n_tokens) == (len(encoding().encode_ordinary(r.text)), len(encoding().encode_ordinary(text)))
        assert found.n_chars == len(text)
