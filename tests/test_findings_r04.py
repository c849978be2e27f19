"""Small cases of the findings of round 4: pages are read as arrays, what is built or matched is built and matched once."""

import random

import pytest
from pyspark.sql import functions as F

from trackstats.functions import scalars as S
from trackstats.sources import chart_pages, pages


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


TEXTS = ["1,234", "5", " 12 ", "n/a", "+7", "-3", "99999999999999999999", "9223372036854775807", "9223372036854775808", "0000000000000000000000012", "<b>1</b>2", "&#49;,0",
         "1\n,", "1\r\n,", "1\n\n,", "1 ,", "a - b", "&amp;lt;", "&eacute;", "&#x2013;", "&#0;", "&bogus;", "&", ";", "é", " ", "<a href=x>", "</a>", " ", "\n", "\x0b", ">", ""]
TAGS = ["<table>", "<TABLE class=a>", "</table>", "<tr>", "<Tr x=1>", "</tr>", "</TR>", "<td>", "</td>", "<track>", "<th>", "</tdx>"]
ODD = ["</tr >", "<tr <b>", "</td\n>", "</table x>", "<td", "<table", "</table", "</tr", "<td <td>", "<tr", "<"]


def page(rng: random.Random, odd: bool) -> str:
    some = [*TEXTS, *(rng.sample(ODD, 2) if odd else [])]
    if rng.random() < 0.2:
        return "".join(rng.choice([*some, *TAGS, *TAGS]) for _ in range(rng.randrange(50)))
    made = [rng.choice(["<p>x", "</table>", ""]) if odd else "<p>x", "<table>", "<tr><th>h</th></tr>"]
    for _ in range(rng.randrange(5)):
        cells = ["".join(rng.choice(some if i == 0 or rng.random() < 0.1 else TEXTS[:16]) for _ in range(rng.randrange(1, 5) if i == 0 else 1)) for i in range(rng.randrange(2, 5))]
        made.append("<tr>" + "".join(f"<td>{c}</td>" for c in cells) + (rng.choice(TAGS) if rng.random() < 0.1 else "</tr>"))
    return "".join([*made, rng.choice(["</table>", "</table><table><tr><td>h</td></tr><tr><td>x</td><td>1</td><td>2</td></tr></table>", ""])])


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("size", [64, 1 << 19])
def test_pages_as_arrays_give_the_rows_of_the_columns(spark, monkeypatch, odd, size):
    rng = random.Random(size + odd)
    stored = spark.createDataFrame([(i, None if i % 97 == 0 else page(rng, odd)) for i in range(600)], "year long, html string")
    cells = pages.table_cells(stored, ["year"]).where(F.size("cells") >= 3)
    text = [pages.cell_text(F.get("cells", F.lit(i))) for i in range(3)]
    want = cells.select(text[0].alias("text"), S.grouped_int(text[1]).alias("streams"), S.grouped_int(text[2]).alias("daily"), "year").dropna(subset=["streams", "daily"])
    want = sorted(tuple(r) for r in want.collect())
    got = pages.chart_rows(stored)
    assert sorted(tuple(r) for r in got.select("Artist and Title", "Streams", "Daily", F.col("Year").cast("long")).collect()) == want and len(want) > 100
    monkeypatch.setattr(chart_pages, "CHUNK", size)  # here, as the tasks have a copy of their own
    batches = stored.select("year", F.col("html").cast("binary").alias("html")).toArrow().to_batches()
    found = [tuple(r.values()) for b in chart_pages.rows_of(iter(batches)) for r in b.to_pylist()]
    assert sorted((t, s, d, y) for y, t, s, d in found) == want


def test_pages_are_read_without_a_lambda_for_every_reference(spark):
    got = pages.chart_rows(spark.createDataFrame([("2012", "<table></table>")], "year string, html string"))
    assert "MapInArrow" in plan(got) and "lambda" not in plan(got) and got.dtypes == [
        ("Artist and Title", "string"), ("Artist", "string"), ("Title", "string"), ("Streams", "bigint"), ("Daily", "bigint"), ("Year", "int")]
    assert got.count() == 0


def test_bytes_that_are_no_text(spark):
    html = b"<table><tr></tr><tr><td>a\xff - b</td><td>1</td><td>2</td></tr></table>"
    stored = spark.createDataFrame([(1, bytearray(html)), (2, bytearray(html.replace(b"\xff", b"")))], "year int, html binary")
    assert rows(pages.chart_rows(stored.withColumn("html", F.expr("cast(html as string)"))), "Year") == [
        ("a� - b", "a�", "b", 1, 2, 1), ("a - b", "a", "b", 1, 2, 2)]


FOLDER = "/root/testdata/sf0.001"


def counted_tracks(spark, monkeypatch):
    """Few tracks, among them some without a name or a price, and how often they were asked for."""
    from trackstats.plans import catalogue_queries
    asked = []

    def some(spark, folder):
        asked.append(folder)
        artist = F.when(F.col("id") % 11 != 0, F.concat(F.lit("a"), F.col("id") % 3))
        title = F.when(F.col("id") % 13 != 0, F.concat(F.lit("t"), F.col("id") % 5))
        return spark.range(0, 777, 1, 1).select(
            F.col("id").cast("string").alias("track_id"), artist.alias("Artist"), title.alias("Title"), F.concat(artist, F.lit(" - "), title).alias("artist_title"),
            (F.col("id") % 2 + 1996).cast("int").alias("Year"), F.when(F.col("id") % 17 != 0, F.col("id") * 1000).alias("Streams"), (F.col("id") + 2).alias("duration_ms"),
            F.when(F.col("id") % 7 == 0, "SMALL").otherwise("PROMO").alias("Topic"))
    monkeypatch.setattr(catalogue_queries, "tracks", some)
    return some(spark, ""), asked


def test_tracks_of_the_pages_are_made_once(spark, monkeypatch):
    from trackstats.plans import catalogue_queries
    df, asked = counted_tracks(spark, monkeypatch)
    got = catalogue_queries.html_table_rows(spark, FOLDER)
    assert len(asked) == 2 and "Range (0, 777" not in plan(got)
    end = "éé– &lt;"
    want = df.dropna(subset=["artist_title", "Streams"]).select(
        F.concat("artist_title", F.lit(end)).alias("Artist and Title"), "Artist", F.concat("Title", F.lit(end)).alias("Title"), "Streams", F.col("duration_ms").alias("Daily"), "Year")
    assert rows(got, *got.columns) == rows(want, *got.columns) and got.count() > 500


def test_a_refresh_makes_its_tracks_once(spark, monkeypatch):
    from trackstats.plans import job_queries
    df, asked = counted_tracks(spark, monkeypatch)
    got = job_queries.catalogue_refresh(spark, FOLDER)
    report = job_queries.catalogue_refresh_report(spark, FOLDER)
    assert len(asked) == 3 and "Range (0, 777" not in plan(got) + plan(report)
    fresh = df.dropna(subset=["artist_title", "Streams"])
    base = df.where("Year < 1997 and Topic <> 'SMALL'").select("artist_title", "Year").distinct()
    held = fresh.join(base, ["artist_title", "Year"])
    assert got.where("genre = 'PROMO'").count() == held.count() and got.where("genre is null").count() == fresh.where("Year = 1997").count()
    assert rows(report.select("n_updated", "n_new_years"), "n_updated") == [(held.count(), fresh.where("Year = 1997").count())]


def test_a_number_of_a_track_is_written_once(spark):
    from trackstats.plans.catalogue_queries import stored_chart_pages
    written = stored_chart_pages(spark, FOLDER)._jdf.queryExecution().analyzed().toString()
    assert written.count("format_number(") == 2
