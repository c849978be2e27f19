"""Small cases of the findings of round 3: what is read, computed or moved once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackstats.operators import clean, enrich, merge, scoring, text
from trackstats.plans import inputs, jobs
from trackstats.sources import pages

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_merge_reads_the_fresh_rows_once(spark):
    fresh = spark.range(0, 77, 1, 1).select("id", (F.col("id") % 3).alias("Year"), F.lit(5).alias("n"))
    base = spark.range(0, 4, 1, 1).select("id", F.lit(0).cast("long").alias("Year"), F.lit(0).alias("n"), F.lit("g").alias("genre"))
    assert plan(merge.merge(base, fresh, ["id", "Year"], ["n"])).count("Range (0, 77") == 1


@pytest.mark.parametrize("include_new", [False, True])
def test_merge_with_repeated_and_missing_keys(spark, include_new):
    base = spark.createDataFrame([(1, 2000, 0, "a"), (1, 2000, 0, "b"), (None, 2000, 0, "c"), (3, None, 0, "d")], "k int, Year int, n int, genre string")
    fresh = spark.createDataFrame([(1, 2000, 7, "x"), (1, 2000, 8, "y"), (None, 2000, 9, "z"), (3, None, 1, "u"), (4, None, 2, "v"), (5, 2001, 3, None), (6, 2000, 4, "w")],
                                  "k int, Year int, n int, Title string")
    got = merge.merge(base, fresh, ["k", "Year"], ["n"], include_new=include_new)
    new = merge.unmatched(fresh, base, ["k", "Year"]) if include_new else merge.in_new_years(fresh, base)
    want = merge.refresh(base, fresh, ["k", "Year"], ["n"]).unionByName(new, allowMissingColumns=True)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got, *got.columns) == rows(want, *want.columns) and got.count() == (9 if include_new else 7)


def test_a_reference_is_looked_at_once(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("t"))
    decoded = df.select(pages.decode_references(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert decoded.count("thetasym") == 1


def test_odd_references(values):
    cases = {"&amp;lt;": "&lt;", "&#233;&#xE9;&eacute;": "ééé", "&amp": "&amp", "a&;b": "a&;b", "&#12\n;": "&#12\n;", "&#x110000;": "&#x110000;", "&#xD800;": "&#xD800;",
             "&#0;&#12345678;": "&#0;&#12345678;", "&nope; &amp;": "&nope; &", "&&lt;;": "&<;", "&am p;": "&am p;", "&#38;lt;": "&lt;", "&apos;&Eacute;&thetasym;": "'Éϑ", "": "", "&": "&"}
    assert values([(c,) for c in cases], "t string", pages.decode_references(F.col("t"))) == list(cases.values())


def test_pages_move_as_tracks(spark):
    from trackstats.plans.catalogue_queries import stored_chart_pages
    text = plan(stored_chart_pages(spark, FOLDER))
    assert "collect_list(struct(artist_title" in text


def test_separators(values):
    from trackstats.functions import scalars as S
    got = values([("a - b - c",), ("a",), (" - b",), ("",), (None,), ("a -b",), ("é - ü ",)], "t string", S.artist_part("t"), S.title_part("t"))
    assert got == [("a", "b - c"), ("a", ""), ("", "b"), ("", ""), (None, None), ("a -b", ""), ("é", "ü")]


def test_funnel_reads_the_loaded_rows_once(spark):
    raw = inputs.raw_tracks(spark, FOLDER)
    assert plan(jobs.clean_funnel(raw, required=["energy"], ties=["track_id"])).count("lineitem.parquet") == 3


def test_loading_counts(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 0.0, 1), ("a", -0.0, 1), ("", 1.0, None), (None, 1.0, None), ("a", nan, 1), ("a", None, 1), ("1:a", 2.0, 3), ("1", 2.0, 3)], "s string, x double, y int")
    assert rows(clean.loading_counts(df, ["x"]), "loaded") == [(8, 6, 5)]
    assert rows(clean.distinct_count(df), "rows_out") == [(7,)]
    assert rows(clean.loading_counts(df.limit(0), ["x"]), "loaded") == [(0, 0, 0)]


def test_many_customers_meet_the_orders(spark, monkeypatch):
    few = inputs.tracks(spark, FOLDER)
    monkeypatch.setattr(inputs, "MANY", 0)
    many = inputs.tracks(spark, FOLDER)
    assert few.columns == many.columns and few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty() and many.count() > 0


def test_large_top_n_reads_its_input_once(spark):
    df = spark.range(0, 7777, 1, 1).select("id", (F.col("id") % 2).alias("Year"), (F.col("id") % 50).alias("Streams"))
    top = clean.top_per_year(df, 2000, ties=["id"])
    assert "Range (0, 7777" not in plan(top)
    want = clean.top_n(df, ["Year"], [F.col("Streams").desc(), F.col("id")], 2000)
    assert rows(top, "id") == rows(want, "id")


def test_triples_are_counted_without_a_sort(monkeypatch):
    texts = [b"the cat and the hat", None, b"ab", "hé hé \U0001f600".encode(), b"", b"the"]
    monkeypatch.setattr(scoring, "TABLE", 0)
    want = scoring._counted(texts, "trigrams")
    monkeypatch.undo()
    monkeypatch.setattr(np, "unique", lambda *a, **b: pytest.fail("sorted"))
    got = scoring._counted(texts, "trigrams")
    assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_texts_are_counted_once(spark):
    df = spark.range(0, 333, 1, 1).select(F.lit("de").alias("lang"), F.lit("der und").alias("text"))
    made = text.train_language_profiles(df)
    assert "Range (0, 333" not in plan(made) and made.count() == 5


def test_lyrics_are_cleaned_once(spark):
    df = spark.createDataFrame([(1, "0"), (2, " 0\n"), (3, None), (4, "der und die das der und die das der und"), (5, "")], "k int, Lyrics string")
    profiles = spark.createDataFrame([("de", "der", 5)], "lang string, gram string, weight long")
    assert rows(text.label_language(df, profiles, key="k"), "k") == [(1, "en"), (2, "en"), (3, "en"), (4, "de"), (5, "en")]
    assert plan(text.label_language(df, profiles, key="k")).count(r"\[[^\n]*?\]") == 1


def test_distinct_rows_make_derived_columns_again(spark):
    df = spark.createDataFrame([("a", "b", "ab"), ("a", "b", "ab"), (None, "b", None), ("x", "y", "xy")], "p string, q string, pq string")
    got = clean.distinct_rows(df, derived={"pq": F.concat("p", "q")})
    assert got.columns == df.columns and rows(got, "p") == rows(df.distinct(), "p")


def test_an_answer_is_lowered_once(spark):
    df = spark.createDataFrame([("**Grief AND loss.",)], "raw string").withColumn("Lyrics", F.lit("x"))
    got = enrich.finish_topics(df, "raw")
    assert plan(got).count("lower(") == 1 and rows(got, "Topic") == [("**Grief AND loss.", "x", "Grief and Loss")]


def test_years_are_combined_before_they_move(spark):
    a = spark.range(9).select(F.when(F.col("id") > 2, F.col("id") % 3).alias("Year"))
    b = spark.range(9).select(F.when(F.col("id") > 2, F.col("id") % 4 + 1).alias("Year"))
    both, only = merge.years_in_both(a, b), merge.years_only_in(b, a)
    assert "Join" not in plan(both) + plan(only)
    assert rows(both, "Year") == rows(a.intersect(b), "Year") and rows(only, "Year") == rows(b.subtract(a), "Year")
    assert rows(both, "Year") == [(None,), (1,), (2,)] and rows(only, "Year") == [(3,), (4,)]
