"""Every registered query against its check SQL on the small given tables."""

import os

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from trackstats.plans import catalogue_queries
from trackstats.plans.all_queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck):
    assert compare.difference(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_pages_of_a_large_artist_are_bounded(spark, monkeypatch):
    artist = F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("small"), F.col("id") % 50))
    title = F.concat(F.lit("song"), F.col("id"))
    many = spark.range(9000).select(
        F.col("id").alias("track_id"), artist.alias("Artist"), title.alias("Title"), F.concat(artist, F.lit(" - "), title).alias("artist_title"),
        F.lit(1999).alias("Year"), (F.col("id") + 1).alias("Streams"), (F.col("id") + 2).alias("duration_ms"))
    monkeypatch.setattr(catalogue_queries, "tracks", lambda spark, folder: many)
    pages = catalogue_queries.stored_chart_pages(spark, FOLDER)
    per_page = F.size(F.split("html", "song")) - 1
    assert pages.agg(F.max(per_page)).first()[0] <= 6 * catalogue_queries.PAGE_TRACKS
    got = catalogue_queries.html_table_rows(spark, FOLDER)
    assert sorted(r.Streams for r in got.select("Streams").collect()) == list(range(1, 9001))
