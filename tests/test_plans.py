"""The shape of physical plans: what must and must not appear in them."""

import os

import pytest
from pyspark.sql import functions as F

from trackstats.operators import density, keys, rank, select, stats
from trackstats.plans import inputs, jobs
from trackstats.plans.all_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(name, spark):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{FOLDER}/part.parquet").withColumnRenamed("p_size", "Year")
    chosen = select.Selection(year=7, topic="PROMO").tracks(df, topic="p_type").select("p_partkey")
    text = plan(chosen)
    assert "EqualTo(p_size,7)" in text and "EqualTo(p_type,PROMO)" in text and "p_name" not in text


def test_band_adds_a_range_for_the_scan(spark, tmp_path):
    spark.range(100).select((F.col("id") / 100).alias("energy")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert "GreaterThanOrEqual(energy" in plan(select.Selection(bands={"energy": 0.5}).tracks(df))


def test_top_n_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    text = plan(keys.top_n(df, ["g"], [F.col("id")], 3))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_cleaning_shuffles_by_key_and_year_only(spark):
    raw = inputs.raw_tracks(spark, FOLDER)
    text = plan(jobs.clean_catalogue(raw, required=["energy"], ties=["track_id"]))
    hashed = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    # One for keep-best, two for the salted cut by year; the dimension joins broadcast.
    assert len(hashed) == 3


def test_density_aggregates_before_it_meets_the_grid(spark):
    df = spark.range(1000).select((F.col("id") / 1000).alias("v"))
    text = plan(density.density(df, ["v"], h=0.12))
    # Below the grid points there is a finished aggregation, on both branches of the plan.
    for branch in text.split("Generate explode(")[1:]:
        assert branch.index("Exchange hashpartitioning") < branch.index("Range (")


def test_summaries_read_the_table_once(spark):
    df = inputs.tracks(spark, FOLDER)
    assert plan(stats.means_with_total(df, ["energy", "tempo"])).count("lineitem.parquet") == 1
    assert plan(stats.yearly_means(df, ["energy", "tempo"])).count("lineitem.parquet") == 1
    assert plan(rank.leaderboard(df)).count("lineitem.parquet") == 1
