import pytest
from pyspark.sql import functions as F

from trackstats.operators.keys import membership
from trackstats.plans import jobs
from trackstats.sources import pages, sinks, tables


def write(path, content: str):
    path.write_bytes(content.encode("utf-8"))
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_long_rows_are_skipped_and_short_ones_padded(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n1,2\n3,4,5\n6\n"say ""hi""\nx",NA\n')
    assert rows(tables.read_csv(spark, path)) == [("1", "2"), ("6", None), ('say "hi"\nx', None)]


def test_types_and_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "b.csv", "﻿Year,x\n2010,1.5\n,nan\nbad,zz\n")
    df = tables.read_csv(spark, path, {"Year": "int", "x": "double"})
    assert df.columns == ["Year", "x"]
    assert rows(df) == [(2010, 1.5), (None, None), (None, None)]


def test_ragged_rows(spark, tmp_path):
    path = write(tmp_path / "c.csv", "i,Song,LYRICS\n1,s1\n\n2,s2,text\n")
    df, name = tables.read_ragged_csv(spark, path, "lyrics")
    assert name == "LYRICS" and rows(df) == [("1", "s1", ""), ("2", "s2", "text")]
    df, name = tables.read_ragged_csv(spark, write(tmp_path / "d.csv", "i,Song\n1,s1\n"), "lyrics")
    assert name == "lyrics" and rows(df) == [("1", "s1", "")]


def test_typed_catalogue(spark):
    raw = spark.createDataFrame([("12abc", "x", "7", "12abc", "90000"), (None, "2011", None, "", "-1")],
                                "Streams string, Year string, key string, energy string, duration_ms string")
    out = tables.typed_catalogue(tables.drop_index_columns(raw.withColumn("Unnamed: 0", F.lit(1))), ["energy", "absent"])
    assert rows(out.select("Streams", "Year", "key", "energy", "duration_min")) == [(12.0, 2024, 7, None, 1.5), (0.0, 2011, None, 0.0, 0.0)]
    words = tables.typed_words(spark.createDataFrame([("2010", "5x"), ("", "")], "Year string, Frequency string"))
    assert rows(words) == [(2010, 5), (0, 0)]


PAGE = """<p>x</p><TABLE class=a><tr><th>h</th></tr>
<tr><td> <a href='#'>A &amp; B</a> - <b>T</b> </td><td>1,234</td><td>5</td><td>extra</td></tr>
<tr><td>Solo</td><td>7</td><td>8</td></tr><tr><td>two</td><td>1</td></tr><tr><td>bad - x</td><td>n/a</td><td>1</td></tr>
</TABLE><table><tr><td>h</td></tr><tr><td>second - table</td><td>1</td><td>2</td></tr></table>"""


def test_chart_rows(spark):
    stored = spark.createDataFrame([(2012, PAGE), (2013, "no table")], "year int, html string")
    got = rows(pages.require_rows(pages.chart_rows(stored)))
    assert got == [("A & B-T", "A & B-T", "", 1234, 5, 2012), ("Solo", "Solo", "", 7, 8, 2012)]
    with pytest.raises(ValueError):
        pages.require_rows(pages.chart_rows(stored.where("year = 2013")))


def test_references_tags_and_nested_tables(spark):
    html = ("<table><tr><th>h</th></tr><track><tr><td>a<table><tr><td>x</td></tr></table></td><td>1</td></tr>"
            "<tr ><td>Beyonc&eacute; &#233;&#xe9;&#8211; &bogus; &#0; & &amp;lt; - T</td><td>1</td><td>2</td></tr></table><p></p>")
    stored = spark.createDataFrame([(2012, html)], "year int, html string")
    assert [r["Artist and Title"] for r in pages.chart_rows(stored).collect()] == ["Beyoncé éé– &bogus; &#0; & &lt; - T"]
    items = spark.createDataFrame([("<link rel=x>no<li class=a>one</li><LI>two</li>",)], "html string")
    assert [r.item for r in pages.list_items(items, []).collect()] == ["one", "two"]


def test_refresh_from_pages(spark):
    html = "<table><tr><th>h</th></tr><tr><td>A - T</td><td>10</td><td>1</td></tr><tr><td>N - T</td><td>3</td><td>1</td></tr></table>"
    stored = spark.createDataFrame([(2012, html)], "year int, html string")
    base = spark.createDataFrame([("A - T", "A", "T", 1, 1, 2012, "pop")],
                                 "`Artist and Title` string, Artist string, Title string, Streams long, Daily long, Year int, genre string")
    merged, report = jobs.refresh_catalogue(base, stored, include_new=True)
    assert sorted((r["Artist and Title"], r.Streams, r.genre) for r in merged.collect()) == [("A - T", 10, "pop"), ("N - T", 3, None)]
    assert rows(report) == [(1, 0, 1, 0)]


def test_responses(spark):
    df = spark.createDataFrame([(1, '{"id": "abc", "energy": 0.5, "tempo": "120"}'), (2, '{"valence": 0.1, "energy": {"x": 1}}'), (3, "broken"), (4, None)], "id int, r string")
    out = pages.with_features(df, "r", ["energy", "tempo", "valence"])
    assert out.columns == ["id", "r", "energy", "tempo", "valence"]
    assert rows(out.drop("r").orderBy("id")) == [(1, 0.5, 120.0, None), (2, None, None, 0.1), (3, None, None, None), (4, None, None, None)]
    assert set(rows(pages.feature_rows(df, ["id"], "r"))) == {
        (1, "id", None), (1, "energy", 0.5), (1, "tempo", 120.0), (2, "valence", 0.1), (2, "energy.x", 1.0)}
    ids = spark.createDataFrame([('{"content":[{"id":"q"}]}',), ('{"content":[]}',), ("x",)], "r string")
    assert [r[0] for r in ids.select(pages.content_id("r")).collect()] == ["q", None, None]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b'), (2, "line\nbreak")], "id int, text string")
    sinks.write_csv(df, str(tmp_path / "out"), bom=True)
    back = tables.read_csv(spark, str(tmp_path / "out"), {"id": "int"})
    assert sorted(rows(back)) == sorted(rows(df))
    with pytest.raises(Exception):
        sinks.write_csv(df, str(tmp_path / "out"))


def test_publish_switches_versions(spark, tmp_path):
    first = sinks.publish(spark.range(3), "catalogue_view", str(tmp_path / "cat"), "1")
    assert first.count() == 3
    grown = spark.table("catalogue_view").union(spark.range(10, 12))  # reads the version it replaces
    assert sinks.publish(grown, "catalogue_view", str(tmp_path / "cat"), "2").count() == 5
    spark.sql("DROP VIEW catalogue_view")


def test_batches_resume_and_repeat(spark, tmp_path):
    path = str(tmp_path / "progress")
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    assert sinks.pending(df, path, "id").count() == 10
    sinks.save_batch(df.where("id < 4"), path, 1)
    sinks.save_batch(df.where("id < 4"), path, 1)  # a repeated batch replaces itself
    sinks.save_batch(df.where("id between 4 and 6"), path, 2)
    saved = sinks.saved_batches(spark, path, df.schema)
    assert saved.count() == 7 and membership(df, saved, ["id"], present=False).count() == 3
    assert sorted(r.id for r in sinks.pending(df, path, "id").collect()) == [7, 8, 9]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("split", [23, 120, 1 << 20])
def test_quoted_line_ends_in_a_splittable_read(spark, tmp_path, seed, split):
    import csv
    import io
    import random
    rng = random.Random(seed)
    words = ["a", "b c", "", '"', ",", "\n", "\r\n", 'say "x"', "long " * 30, "é", "5\" disk\n"]
    want = []
    for f in range(3):
        out = io.StringIO()
        w = csv.writer(out, lineterminator="\r\n" if f == 1 else "\n", quoting=csv.QUOTE_ALL if f == 2 else csv.QUOTE_MINIMAL)
        w.writerow(["id", "xé", "y"])
        for i in range(rng.randrange(1, 40)):
            row = [f"{f}-{i}", "".join(rng.choice(words) for _ in range(rng.randrange(4))), rng.choice(words)]
            w.writerow(row)
            want.append(row)
        (tmp_path / f"{f}.csv").write_bytes(out.getvalue().encode() if f else out.getvalue().encode().rstrip(b"\n"))
    for name, value in (("maxPartitionBytes", split), ("openCostInBytes", 0)):
        spark.conf.set(f"spark.sql.files.{name}", str(value))
    try:
        got = rows(tables.read_ragged_csv(spark, str(tmp_path), "y")[0])
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")
    assert sorted(got) == sorted((a, b, c) for a, b, c in want)


def test_lines_within_quotes(tmp_path):
    from trackstats.sources.records import ends_inside
    assert [ends_inside(t, False) for t in ('a,b', '"a', 'a,"b""', 'a,"b"', 'a 5" b,c', '"a"b,"', '"a""', '""', '"""', '', 'a,')] == [
        False, True, True, False, False, True, True, False, True, False, False]
    assert [ends_inside(t, True) for t in ('a,b', 'a"', 'a""', 'a"",b"', 'a","b', 'a",5" b', '"', '""')] == [
        True, False, True, False, True, False, False, True]


def test_a_quote_that_is_never_closed_keeps_its_text(spark, tmp_path):
    path = write(tmp_path / "open.csv", 'a,b\n1,2\n3,"x\ny\n')
    assert rows(tables.read_csv(spark, path, one_line=False).select("a")) == [("1",), ("3",)]
    assert rows(tables.read_csv(spark, write(tmp_path / "e.csv", "a,b\n"))) == []
    assert rows(tables.read_csv(spark, write(tmp_path / "one.csv", "a,b\n1,2\n"), one_line=True)) == [("1", "2")]


def test_members_of_any_name_and_depth(spark):
    long_ = "y" * 200_000
    data = [(1, '{"id":"abc","nested":{"energy":1,"deep":{"x y":"2.5"}},"a.b":3,"list":[1,{"q":1}],"none":null,"no":true,"empty":{}}'),
            (2, '{"nested":5,"text":"{not an object}","pad":"' + long_ + '","last":1e3}'), (3, "bad"), (4, None), (5, "{}"), (5, "[1]")]
    df = spark.createDataFrame(data, "k int, r string")
    assert pages.nesting(df, "r") == 2
    got = sorted(rows(pages.feature_rows(df, ["k"], "r")), key=str)
    assert got == sorted([(1, "id", None), (1, "nested.energy", 1.0), (1, "nested.deep.x y", 2.5), (1, "a.b", 3.0), (1, "list", None), (1, "none", None),
                          (1, "no", None), (2, "nested", 5.0), (2, "text", None), (2, "pad", None), (2, "last", 1000.0)], key=str)
    wide = pages.with_all_features(df.select("k", "r"), "r").drop("r")
    assert wide.columns == ["k", "a.b", "id", "last", "list", "nested", "nested.deep.x y", "nested.energy", "no", "none", "pad", "text"]
    by = {r.k: r.asDict() for r in wide.where("k < 5").collect()}
    assert (by[1]["a.b"], by[1]["nested.deep.x y"], by[1]["nested"], by[2]["nested"], by[2]["last"], by[3]["last"]) == (3.0, 2.5, None, 5.0, 1000.0, None)
    with pytest.raises(ValueError, match="more than 3"):
        pages.with_all_features(df, "r", most=3)
