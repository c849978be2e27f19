import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackstats.operators import clean, density, enrich, evolution, keys, labels, layout, merge, ordering, rank, scoring, select, stats, text
from trackstats.plans import jobs


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- keys ------------------------------------------------------------------------

def test_membership_and_lookup_match_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(keys.membership(left, right, ["k"], present=True), "v") == [("a", 1), (None, 2)]
    assert rows(keys.membership(left, right, ["k"], present=False)) == [("b", 3)]
    table = spark.createDataFrame([(None, "n"), ("b", "x")], "k string, t string")
    assert rows(keys.lookup(left, table, ["k"], "left"), "v") == [("a", 1, None), (None, 2, "n"), ("b", 3, "x")]


@pytest.mark.parametrize("salt_by", [None, ["id"]])
def test_top_n_with_a_hot_group(spark, salt_by):
    data = [(("hot" if i % 3 else f"g{i % 11}"), (i * 37) % 500, i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    got = rows(keys.top_n(df, ["g"], [F.col("v").desc(), F.col("id")], 20, rank="r", salt_by=salt_by), "g", "r")
    want = []
    for g in sorted({d[0] for d in data}):
        best = sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2]))[:20]
        want += [(*d, i + 1) for i, d in enumerate(best)]
    assert got == want


@pytest.mark.parametrize("ranges", [1, 4, 13, 1000])
def test_row_index_is_consecutive_and_ordered(spark, ranges):
    data = [(random.Random(i).randrange(5), i) for i in range(997)]
    df = spark.createDataFrame(data, "v int, id int").repartition(7)
    indexed = ordering.with_row_index(df, ["v", "id"], "i", ranges=ranges)
    assert rows(indexed, "i") == [(v, i, n) for n, (v, i) in enumerate(sorted(data))]
    per = [r["count"] for r in ordering.with_range(df, ["v", "id"], ranges=ranges).groupBy(ordering.RANGE).count().collect()]
    assert len(per) == min(ranges, 997) if ranges < 100 else len(per) > 60
    assert max(per) < 997 / ranges * 2 + 30


@pytest.mark.parametrize("ranges", [1, 3, 10])
def test_row_index_of_any_order(spark, ranges):
    data = [(random.Random(i).choice([None, "a", "b", "ß", "c"]), random.Random(-i).choice([None, 1.5, -2.0, 0.0]), i) for i in range(300)]
    df = spark.createDataFrame(data, "s string, x double, id int").repartition(5)
    by = [ordering.By("s", descending=True, nulls_last=True), ordering.By("x", nulls_last=True), ordering.By("id", descending=True)]
    want = rows(df, F.col("s").desc_nulls_last(), F.col("x").asc_nulls_last(), F.col("id").desc())
    assert [r[:3] for r in rows(ordering.with_row_index(df, by, "i", ranges=ranges), "i")] == want
    assert ordering.with_row_index(df.limit(0), by, "i", ranges=ranges).count() == 0
    assert rows(ordering.with_row_index(df.limit(1), by, "i", ranges=ranges).select("i")) == [(0,)]


def test_row_index_runs_no_job_and_writes_nothing_before_the_action(spark):
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    indexed = rank.batch_numbers(spark.range(1000), ["id"], 10)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == jobs_before
    assert "ExistingRDD" not in indexed._jdf.queryExecution().optimizedPlan().toString() and indexed.agg(F.max("batch")).first()[0] == 100


def test_running_sum_over_ranges(spark):
    data = [(i, random.Random(i).choice([None, 1, 5, -3])) for i in range(500)]
    df = spark.createDataFrame(data, "y int, v long").repartition(6)
    total, want = 0, []
    for y, v in data:
        total += v or 0
        want.append((y, v, total))
    assert rows(ordering.with_running_sum(df, ["y"], "v", "t", ranges=7), "y") == want


def test_top_n_beyond_any_threshold(spark):
    data = [(1 if i % 10 else i, random.Random(i).randrange(400), i) for i in range(6000)]
    df = spark.createDataFrame(data, "g int, v int, id int").repartition(8)
    top = ordering.top_n_by_ranges(df, ["g"], [ordering.By("v", descending=True), "id"], 2000, rank="r", ranges=12)
    want = []
    for g in sorted({d[0] for d in data}):
        best = sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2]))[:2000]
        want += [(*d, i + 1) for i, d in enumerate(best)]
    assert rows(top, "g", "r") == want
    sizes = ordering.with_range(df, ["g", ordering.By("v", descending=True), "id"], ranges=12).groupBy(ordering.RANGE).count()
    assert sizes.agg(F.max("count")).first()[0] < 1500  # the hot group has 5400 rows


@pytest.mark.parametrize("ranges", [1, 2, 9])
def test_as_of_on_any_grid(spark, ranges):
    rng = random.Random(ranges)
    grids = {g: sorted({round(rng.uniform(-3, 3) ** 3, 2) for _ in range(40)}) for g in ("a", "b", None)}
    points = [(g, x, f"{g}{x}") for g, xs in grids.items() for x in xs]
    asked = [(rng.choice(["a", "b", None, "no points"]), rng.choice([None, float("nan"), -99.0, 99.0, rng.uniform(-20, 20), rng.choice(grids["a"])]), i) for i in range(400)]
    asked += [("a", 0.5, 1000 + i) for i in range(300)]
    got = rows(ordering.as_of(spark.createDataFrame(asked, "g string, v float, id int").repartition(4),
                              spark.createDataFrame(points, "g string, x double, tag string").repartition(3), "v", at="x", by=["g"], ranges=ranges), "id")
    want = []
    for g, v, i in asked:
        if v is None or v != v or g not in grids:
            continue
        f = float(np.float32(v))
        x = next((p for p in grids[g] if p >= f), grids[g][-1])
        want.append((i, x, f"{g}{x}"))
    assert [(r[2], r[3], r[4]) for r in got] == sorted(want)


@pytest.fixture()
def small_skew(spark):
    """Thresholds low enough for AQE to see skew in a few thousand rows."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["left", "left_anti", "refresh"])
def test_hot_key_is_split(spark, small_skew, kind):
    """A third of the rows share a key; the join shuffles both sides itself and AQE splits the hot one."""
    left = spark.range(60000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), F.uuid().alias("pad"))
    right = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    if kind == "refresh":
        joined = merge.refresh(left, right.where("v < 500"), ["k"], ["v"])
    elif kind == "left":
        joined = keys.lookup(left, merge.last_per_key(right, ["k"], "v").withColumnRenamed("v", "w"), ["k"], "left")
    else:
        joined = keys.membership(left, right, ["k"], present=False)
    found = joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    ks = [1 if i % 3 == 0 else i for i in range(60000)]
    want = {"left": 60000, "left_anti": sum(k >= 500 for k in ks), "refresh": sum(k < 500 for k in ks)}[kind]
    assert len(found) == want


# --- cleaning ---------------------------------------------------------------------

def test_clean_job(spark):
    data = [("A", "T", "10", 2000, 1.0, 1), ("A", "T", "30", 2000, 1.0, 2), ("A", "T", "30", 2000, 1.0, 2),
            ("B", "T", "1,5", 2000, 1.0, 3), ("C", "T", "5", None, 1.0, 4), ("D", "T", "7", 2000, None, 5),
            ("E", "T", "7", 2001, float("nan"), 6), (None, "T", "3", 2001, 1.0, 7), (None, "T", "4", 2001, 1.0, 8)]
    raw = spark.createDataFrame(data, "Artist string, Title string, Streams string, Year int, energy double, id int")
    raw = raw.withColumn("genres", F.lit("x"))
    options = dict(required=["energy", "absent"], ties=["id"], n=1)
    assert rows(jobs.clean_funnel(raw, **options), "step_no") == [
        (0, "loaded", 9, 0), (1, "missing", 7, 2), (2, "copies", 6, 1), (3, "repeated keys", 4, 2), (4, "top rows", 2, 2)]
    final = jobs.clean_catalogue(raw, **options)
    assert "genres" not in final.columns
    assert rows(final.select("Artist", "Streams", "id"), "id") == [("A", 30.0, 2), (None, 4.0, 8)]


def test_quality_report_counts_nan_and_copies(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", float("nan")), (None, None)], "k string, x double")
    assert set(rows(clean.quality_report(df, ["k"]))) == {
        ("missing", "k", 1), ("missing", "x", 2), ("duplicate_rows", None, 1), ("duplicate_keys", None, 2)}


def test_long_texts_are_counted_by_digest(spark):
    df = spark.createDataFrame([("x" * 100, 1), ("x" * 100, 1), ("x" * 99, 1), (None, 1), ("", 1)], "t string, n int")
    assert ("duplicate_rows", None, 1) in rows(clean.quality_report(df))
    assert rows(clean.distinct_count(df)) == [(4,)]


# --- merge ------------------------------------------------------------------------

BASE = [("a", 1999, 1, 1, "g1"), ("a", 1999, 2, 2, "g2"), ("b", 1999, 3, 3, "g3"), (None, 1999, 4, 4, "g4"), ("o", 1995, 5, 5, "g5")]
FRESH = [("a", 1999, 100, 10), ("a", 1999, 200, 20), (None, 1999, 400, 40), ("n", 1999, 300, 30), ("z", 2001, 900, 90)]


def _merge_inputs(spark):
    base = spark.createDataFrame(BASE, "k string, Year int, Streams long, Daily long, genre string")
    return base, spark.createDataFrame(FRESH, "k string, Year int, Streams long, Daily long")


def test_merge_keeps_the_documented_quirks(spark):
    base, fresh = _merge_inputs(spark)
    keys_, measures = ["k", "Year"], ["Streams", "Daily"]
    refreshed = merge.refresh(base, fresh, keys_, measures)
    assert sorted(rows(refreshed), key=str) == sorted([
        ("a", 1999, 100, 10, "g1"), ("a", 1999, 200, 20, "g1"), ("a", 1999, 100, 10, "g2"), ("a", 1999, 200, 20, "g2"),
        (None, 1999, 400, 40, "g4")], key=str)  # duplicates multiply, NULL matches, 1995 is gone
    merged = rows(merge.merge(base, fresh, keys_, measures).select("k", "Year", "Streams", "genre"))
    assert ("z", 2001, 900, None) in merged and len(merged) == 6
    merged = rows(merge.merge(base, fresh, keys_, measures, include_new=True).select("k", "Year", "Streams", "genre"))
    assert ("n", 1999, 300, None) in merged and len(merged) == 7
    assert rows(merge.reconcile(base, fresh, keys_)) == [(5, -1, 1, 1)]


def test_fresh_rows_are_partitioned(spark):
    base, fresh = _merge_inputs(spark)
    matched = merge.matched(fresh, base, ["k", "Year"]).count()
    new = merge.new_in_shared_years(fresh, base, ["k", "Year"]).count()
    assert matched + new + merge.in_new_years(fresh, base).count() == len(FRESH)


def test_patch_takes_the_last_row(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 2, "t"), (None, 3, "t")], "k string, x int, other string")
    source = spark.createDataFrame([("a", 10, 1), ("a", None, 2), ("", 7, 3), (None, 8, 4)], "k string, x int, load_no int")
    out = merge.patch_columns(target, source.withColumn("missing_in_target", F.lit(1)), "k", ["x", "missing_in_target"], "load_no")
    assert rows(out, "x") == [("a", None, "t"), ("b", 2, "t"), (None, 3, "t")]
    assert rows(merge.patch_report(target, source, "k", ["x"])) == [(1, 2, ["b"])]


def test_fill_from_lookup(spark):
    songs = spark.createDataFrame([("s1", "a", 2010, ""), ("s2", "a", 2010, " "), ("s3", "a", 2011, ""), ("s4", "a", 2011, "has"),
                                   ("", "a", 2010, ""), ("s5", "a", 2010, None), ("s6", "a", 2010, "")],
                                  "song string, artist string, Year int, lyrics string")
    found = spark.createDataFrame([("s1", "a", "l1\r\nl2"), ("s4", "a", "other"), ("s5", "a", None)],
                                  "song string, artist string, text string")
    out = merge.fill_from_lookup(songs, found, keys=["song", "artist"], text="lyrics", found_text="text", year="Year", target_year=2010)
    assert rows(out.select("song", "lyrics"), "song") == [
        ("", ""), ("s1", "l1 l2"), ("s2", "0"), ("s4", "has"), ("s5", ""), ("s6", "0")]


def test_resume(spark):
    df = spark.createDataFrame([(0, "x"), (1, None), (2, "y"), (3, " "), (4, None)], "i long, t string")
    assert [r.i for r in merge.after_last_success(df, "i", "t").orderBy("i").collect()] == [3, 4]
    assert [r.i for r in merge.after_last_success(df, "i", "t", retry_gaps=True).orderBy("i").collect()] == [1, 3, 4]
    assert merge.after_last_success(df.where("t is null"), "i", "t").count() == 2
    saved = spark.createDataFrame([(1, "old", 5, 1), (1, "new", 6, 2)], "i long, t string, extra int, load_no int")
    assert rows(merge.overlay(df, saved, "i", "load_no"), "i") == [
        (0, "x", None), (1, "new", 6), (2, "y", None), (3, " ", None), (4, None, None)]
    assert [r.i for r in merge.next_batch(df, saved, "i", 2).collect()] == [0, 2]


# --- selection and statistics --------------------------------------------------------

def test_band_edge(spark):
    df = spark.createDataFrame([(0.351,), (0.349,), (0.649,), (0.651,), (0.5,), (None,)], "energy double")
    chosen = select.Selection(bands={"energy": 0.5}).tracks(df)
    assert [r.energy for r in chosen.orderBy("energy").collect()] == [0.351, 0.5, 0.649]


def test_language_filter_is_optional(spark):
    df = spark.createDataFrame([("en",), ("de",)], "language string")
    assert select.only_language(df).count() == 1
    assert select.only_language(df.drop("language")).count() == 2


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0), (4.0, 4.0, 5.0)], "x double, y double, c double")
    r = {(a, b): (n, v) for a, b, n, v in rows(stats.correlation(df, ["x", "y", "c", "absent"]).select("feature_x", "feature_y", "n", "r"))}
    assert len(r) == 9
    assert r["x", "y"][0] == 3 and math.isclose(r["x", "y"][1], 0.7857142857142857) and r["x", "y"] == r["y", "x"]
    assert math.isclose(r["x", "x"][1], 1.0) and r["c", "c"][1] is None and r["x", "c"][1] is None


def test_correlation_constant_on_shared_rows_only(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 4.0), (0.7, None)], "x double, y double")
    r = {(a, b): v for a, b, v in rows(stats.correlation(df, ["x", "y"]).select("feature_x", "feature_y", "r"))}
    assert r["x", "y"] is None and math.isclose(r["x", "x"], 1.0)


def test_stats_bounds_and_means(spark):
    df = spark.createDataFrame([(0.2, 100.0, -10.0), (0.4, float("nan"), -20.0)], "energy double, tempo double, grade double")
    got = {r[0]: r[1:] for r in rows(stats.feature_stats(df, df.limit(1), ["energy", "tempo", "grade"]).select("feature", "min", "max", "mean"))}
    assert got["energy"][:2] == (0.0, 1.0) and got["tempo"][:2] == (0.0, 100.0) and got["grade"][:2] == (-20.0, -10.0)


def test_dense_years(spark):
    df = spark.createDataFrame([(2002, 1.0), (2004, 3.0), (2004, 5.0), (None, 9.0)], "Year int, x double")
    assert rows(stats.yearly_means(df, ["x"]), "Year") == [(2002, 1.0), (2003, 0.0), (2004, 4.0)]
    total = {r[0]: r[1:] for r in rows(stats.means_with_total(df.where("Year is not null"), ["x"]))}
    assert total == {"2002": (1, 1.0), "2004": (2, 4.0), "All Time": (3, 3.0)}


# --- density -------------------------------------------------------------------------

def test_tick_grid():
    assert density.tick_grid(0, 1, 60) == (0, 50, 0.02)
    assert density.tick_grid(0, 1, 25)[2] == 0.05
    assert density.tick_grid(-60, 0, 60) == (-60, 0, 1.0)


@pytest.mark.parametrize("h", [0.12, 0.04, 0.035])
def test_density_equals_the_definition(spark, h):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b"]), rng.choice([0.0, 1.0, 0.5, rng.random(), 1.7])) for _ in range(300)]
    df = spark.createDataFrame([*data, ("a", None), ("b", float("nan"))], "g string, v double")
    got = {(g, round(x, 6)): d for g, _, x, d, _ in rows(density.density(df, ["v"], h=h, group=["g"]))}
    assert len(got) == 102
    for g in "ab":
        vals = [v for k, v in data if k == g]
        for i in range(51):
            x = i / 50
            k = [0.75 * (1 - ((x - v) / h) ** 2) / h if abs((x - v) / h) <= 1 else 0 for v in vals]
            assert math.isclose(got[g, round(x, 6)], sum(k) / len(vals), abs_tol=1e-9)


def test_density_area_and_total(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("Year"), (0.3 + F.rand(5) * 0.4).alias("v"))
    curve = density.density_with_total(df, ["v"], group="Year", h=0.12)
    areas = [r.area for r in curve.groupBy("period").agg((F.sum("density") * 0.02).alias("area")).collect()]  # no weight at the ends
    assert len(areas) == 5 and all(abs(a - 1) < 0.01 for a in areas)
    curve = density.density_with_total(df.withColumn("Year", F.when(F.col("Year") > 0, F.col("Year"))), ["v"], group="Year", h=0.12)
    direct = density.density(df, ["v"], h=0.12)  # rows without a year belong to the total only
    assert curve.select("period").distinct().count() == 4
    total = {round(r.x, 6): r.density for r in curve.where("period = 'All Time'").collect()}
    assert all(math.isclose(total[round(r.x, 6)], r.density, abs_tol=1e-9) for r in direct.collect())


def test_lookup_and_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.011,), (1.0,), (1.5,)], "v double")
    curve = density.density(df, ["v"], h=0.12)
    at = {r.v: r.curve_x for r in density.density_at(df, curve, "v").collect()}
    assert at == {0.0: 0.0, 0.011: 0.02, 1.0: 1.0, 1.5: 1.0}
    bins = rows(density.histogram(df, "v", bins=10), "x0")
    assert len(bins) == 10 and bins[0][2] == 2 and bins[-1][2] == 1


# --- rankings, layers --------------------------------------------------------------------

def test_every_nth(spark):
    df = spark.range(3001).repartition(5)
    assert [r.id for r in rank.every_nth(df, ["id"]).orderBy("id").collect()] == list(range(0, 3001, 3))
    assert rank.every_nth(spark.range(1500), ["id"]).count() == 1500


def test_category_totals_default_is_not_hidden(spark):
    df = spark.createDataFrame([("Other", 5), (None, 3), ("", 1), ("Time", 4), ("Slang", 0)], "Category string, Frequency int")
    assert rows(evolution.category_totals(df)) == [("Time", 4, 50.0), ("other", 4, 50.0)]


def test_shares_add_up(spark):
    df = spark.createDataFrame([(2000, "a"), (2000, "b"), (2000, None), (2001, "c")], "Year int, Topic string")
    first, second = rows(evolution.share_by_year(df, ["a", "b"]), "Year")
    assert first == pytest.approx((2000, 100 / 3, 100 / 3, 100 / 3)) and second == (2001, 0.0, 0.0, 100.0)


def _wiggle(matrix):
    n, y, out = len(matrix[0]), 0.0, [0.0]
    for j in range(1, len(matrix)):
        s1 = s2 = 0.0
        for i in range(n):
            s3 = (matrix[j][i] - matrix[j - 1][i]) / 2 + sum(matrix[j][k] - matrix[j - 1][k] for k in range(i))
            s1, s2 = s1 + matrix[j][i], s2 + s3 * matrix[j][i]
        y -= s2 / s1 if s1 else 0
        out.append(y)
    return out


def test_stack_wiggle_and_labels(spark):
    rng = random.Random(3)
    matrix = [[rng.randrange(60) for _ in range(5)] for _ in range(9)]
    matrix[4] = [0] * 5
    long = spark.createDataFrame([(2000 + j, i, f"s{i}", v) for j, r in enumerate(matrix) for i, v in enumerate(r)],
                                 "Year int, series_no int, series string, value int")
    base = evolution.wiggle_baseline(long)
    assert [r.baseline for r in base.orderBy("Year").collect()] == pytest.approx(_wiggle(matrix))
    layers = evolution.stack_layers(long, offset="wiggle")
    assert all(math.isclose(r.y1 - r.y0, r.value, abs_tol=1e-9) for r in layers.collect())
    for r in evolution.label_anchors(layers).collect():
        column = [row[int(r.series[1:])] for row in matrix]
        thick = [j for j, v in enumerate(column) if v >= max(column) / 2]
        assert abs(r.x - 2004) == min(abs(j - 4) for j in thick) and r.thickness > 10
    assert {r.Year for r in evolution.middle_points(layers, min_thickness=0.0).collect()} == {2004}
    order = [r.series for r in evolution.inside_out_order(long).orderBy("position").collect()]
    assert sorted(order) == [f"s{i}" for i in range(5)]


def test_inside_out_balances_around_the_first_peak(spark):
    peaks = {"a": 0, "b": 1, "c": 2, "d": 3}
    data = [(2000 + y, i, s, 10 if y == p else 1) for i, (s, p) in enumerate(peaks.items()) for y in range(4)]
    long = spark.createDataFrame(data, "Year int, series_no int, series string, value int")
    assert [r.series for r in evolution.inside_out_order(long).orderBy("position").collect()] == ["c", "a", "b", "d"]
    moved = evolution.reorder(long, evolution.inside_out_order(long))
    assert {(r.series, r.series_no) for r in moved.select("series", "series_no").distinct().collect()} == {
        ("c", 0), ("a", 1), ("b", 2), ("d", 3)}


# --- text --------------------------------------------------------------------------------

def test_top_words_against_brute_force(spark):
    lines = [("[Chorus] Running runs, the RUNNER ran", "en", 2000), ("loving lovers loved dancing", "en", 2000),
             ("dancing dances danced café", "en", 2001), ("nicht zählen", "de", 2001)]
    df = spark.createDataFrame(lines, "Lyrics string, language string, Year int")
    assert rows(text.top_words(df, 3), "Year", F.col("Frequency").desc(), "Word") == [
        (2000, "loved", 2), (2000, "running", 2), (2000, "dancing", 1),
        (2001, "danced", 3), (2001, "café", 1)]
    lemmas = spark.createDataFrame([("ran", "run"), ("runner", "run")], "word string, lemma string")
    counted = text.stem_counts(text.word_counts(df, ["Year"]), ["Year"], lemmas=lemmas)
    assert ("run", 4) in {(r.stem, r.Frequency) for r in counted.collect()}


def test_stopword_table_equals_list(spark):
    df = spark.createDataFrame([("alpha beta gamma beta",)], "Lyrics string")
    table = spark.createDataFrame([("beta",), ("beta",)], "w string")
    assert rows(text.word_counts(df, [], stopwords=table), "word") == rows(text.word_counts(df, [], stopwords=["beta"]), "word")


@pytest.mark.parametrize("many", [False, True])
def test_language(spark, many):
    train = spark.createDataFrame([("the quick brown fox jumps over the lazy dog and the cat", "en"),
                                   ("der schnelle braune fuchs springt über den faulen hund und die katze", "de")], "text string, lang string")
    docs = spark.createDataFrame([(1, "the fox and the dog and the other lazy cat over there"), (2, "[x] der hund und die katze und der schnelle fuchs"),
                                  (3, "der hund"), (4, "0"), (5, None), (6, " "), (7, "ж" * 40)], "id int, Lyrics string")
    profiles = text.train_language_profiles(train)
    if many:
        extra = spark.range(120).select(F.concat(F.lit("x"), "id").alias("lang"), F.lit("###").alias("gram"), F.lit(1).cast("long").alias("weight"))
        profiles = profiles.unionByName(extra)
    got = text.label_language(docs, profiles, key="id")
    assert rows(got, "id") == [(1, "en"), (2, "de"), (3, "en"), (4, "en"), (5, "en"), (6, "en"), (7, "en")]


def test_sentiment(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.5)], "word string, weight double")
    docs = spark.createDataFrame([(1, "Good, good day"), (2, "[bad] so bad"), (3, ""), (4, None)], "id int, Lyrics string")
    assert rows(text.sentiment(docs, lexicon, key="id"), "id") == [
        (1, round(4 / math.sqrt(31), 4)), (2, round(-2.5 / math.sqrt(6.25 + 15), 4)), (3, 0.0), (4, 0.0)]


def test_scores_of_repeated_and_missing_keys(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.5)], "word string, weight double")
    data = [(1, "good"), (1, "bad"), (1, "good"), (None, "good good"), (None, ""), (None, None)]
    docs = spark.createDataFrame(data, "id int, Lyrics string")
    score = lambda s: round(s / math.sqrt(s * s + 15), 4)
    got = sorted(((r.id or 0), r.Sentiment_Score) for r in text.sentiment(docs, lexicon, key="id").collect())
    assert got == sorted([(1, score(2)), (1, score(-2.5)), (1, score(2)), (0, score(4)), (0, 0.0), (0, 0.0)])
    words = spark.createDataFrame([("good", "A", 1), ("bad", "B", 1)], "word string, topic string, weight int")
    found = sorted(((r.id or 0), r.Topic) for r in enrich.keyword_topics(docs, words, key="id").collect())
    assert found == sorted([(1, "A"), (1, "B"), (1, "A"), (0, "A"), (0, "Other"), (0, "Other")])
    profiles = spark.createDataFrame([("de", "und", 5), ("en", "the", 5)], "lang string, gram string, weight long")
    texts = spark.createDataFrame([(None, "the " * 20), (None, "und " * 20), (3, "the " * 20), (3, "und " * 20)], "id int, Lyrics string")
    labels = sorted(((r.id or 0), r.language) for r in text.label_language(texts, profiles, key="id").collect())
    assert labels == [(0, "de"), (0, "en"), (3, "de"), (3, "en")]


def test_split_size_may_be_written_with_a_unit(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256MB")
    try:
        assert text.words(spark.createDataFrame([("a b",)], "Lyrics string"), []).count() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dashboard_charts(spark):
    tracks = spark.createDataFrame([(f"t{i}", "A", 2000 + i % 3, 10 + i, 60.0 + i, -30.0 + i, i % 12, i % 2, "Faith and Spirituality") for i in range(30)],
                                   "track_id string, Artist string, Year int, Streams long, tempo double, loudness double, key int, mode int, Topic string")
    words = spark.createDataFrame([(2000, "a", 3, "Other"), (2001, "b", 2, "Location")], "Year int, Word string, Frequency long, Category string")
    charts = jobs.Dashboard(tracks, words, ["tempo", "loudness"]).charts()
    made = {k: v.collect() for k, v in charts.items()}
    assert all(made.values())
    assert max(r.density for r in made["density"]) > 0 and max(r.density for r in made["ridgeline"]) > 0
    for f in ("tempo", "loudness"):  # the curve's area over the part of the grid that holds the values
        assert 0.8 < sum(r.density for r in made["density"] if r.feature == f) * 0.02 < 1.05


def test_grouped_density_lookup(spark):
    df = spark.createDataFrame([("a", 0.2), ("a", 0.25), ("b", 0.8), (None, 0.5)], "g string, v double")
    curve = density.density(df, ["v"], h=0.12, group=["g"])
    found = density.density_at(df, curve, "v", group=["g"]).collect()
    assert len(found) == 4 and all(r.density > 0 for r in found)
    assert curve.groupBy("g").count().where("count <> 51").count() == 0


def test_text_metrics(spark):
    docs = spark.createDataFrame([("The cat sat. The cake is nice!",), ("",)], "Lyrics string")
    full, empty = rows(text.text_metrics(docs), F.col("n_words").desc())
    assert full[1:4] == (7, 2, 7)
    assert math.isclose(full[4], 0.39 * 3.5 + 11.8 - 15.59) and math.isclose(full[5], 6 / 7) and math.isclose(full[6], 22 / 7)
    assert empty[1] == 0 and empty[4:] == (None, None, None)


def test_topics(spark):
    docs = spark.createDataFrame([(1, "party all night at the party club"), (2, " "), (3, "nothing")], "id int, Lyrics string")
    words = spark.createDataFrame(enrich.topic_keywords(), "word string, topic string, weight int")
    assert rows(enrich.keyword_topics(docs, words, key="id"), "id") == [(1, "Party and Club Night"), (2, "Other"), (3, None)]

    def shout(batches):
        for b in batches:
            yield b.assign(raw="**" + b["Lyrics"].str.upper() + "**")[["id", "Lyrics", "raw"]]

    out = enrich.finish_topics(enrich.classify(docs, shout, "id int, Lyrics string, raw string", parallelism=2), "raw")
    assert rows(out.select("id", "Topic"), "id") == [(1, "PARTY ALL NIGHT AT THE PARTY CLUB"), (2, "Other"), (3, "NOTHING")]


def test_feature_batch_flags_every_row(spark):
    songs = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "k int, t string")
    feats = spark.createDataFrame([(1, 0.5), (1, 0.5), (3, 0.7)], "k int, energy double")
    done = spark.createDataFrame([(0,)], "k int")
    out = enrich.feature_batch(songs, feats, key="k", flag="done", batch_size=3, done=done)
    assert rows(out.select("k", "energy", "done"), "k") == [(1, 0.5, True), (2, None, True), (3, 0.7, True)]


@pytest.mark.parametrize("kind", ["words", "trigrams"])
def test_scores_by_blocks_equal_scores_in_the_row(spark, monkeypatch, kind):
    import random
    rng = random.Random(kind)
    texts = [None, "", "zz", *(" ".join(rng.choice(["good", "bad", "sun", "été", "x", "новый"]) for _ in range(rng.randrange(60))) for _ in range(80))]
    docs = spark.createDataFrame([(i % 7 or None, t) for i, t in enumerate(texts)], "id int, t string").repartition(3)
    pieces = ["good", "bad", "été", "never"] if kind == "words" else ["goo", "ood", "été", "d b", "нов", "toolong"]
    model = spark.createDataFrame([(p, lab, w + 0.5) for w, p in enumerate(pieces) for lab in ("A", "B")[:1 + w % 2]] + [("bad", "A", 1.0), (None, "A", 1.0)],
                                  "piece string, label string, weight double")

    def found():
        out = scoring.scored(docs, ["id"], F.col("t"), model, kind=kind).collect()
        return sorted(repr((r.id, [(s.label, s.score) for s in r.scores])) for r in out)
    want = found()
    assert len(want) == len(texts) and any("A" in w for w in want)
    monkeypatch.setattr(scoring, "CHUNK", 300)
    assert found() == want
    monkeypatch.setattr(scoring, "ROWS", 0)
    assert found() == want


def test_scores_make_no_row_per_piece(spark):
    lexicon = spark.createDataFrame([("good", 2.0)], "word string, weight double")
    docs = spark.createDataFrame([(1, "good")], "id int, Lyrics string")
    profiles = spark.createDataFrame([("de", "und", 5)], "lang string, gram string, weight long")
    keywords = spark.createDataFrame([("good", "A", 1)], "word string, topic string, weight int")
    for scored in (text.sentiment(docs, lexicon, key="id"), text.label_language(docs, profiles, key="id"), enrich.keyword_topics(docs, keywords, key="id")):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "Exchange" not in plan
    trained = text.train_language_profiles(docs.select(F.lit("de").alias("lang"), F.col("Lyrics").alias("text")))
    assert "Generate" not in trained._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [1 << 21, 8])
def test_first_of_many_labels(spark, monkeypatch, most):
    monkeypatch.setattr(labels, "MOST", most)
    listed = [(5, "Love"), (2, "Grief"), (9, "lov"), (1, ""), (0, None), (7, "GRIEF"), (3, "é x"), (None, "day")]
    docs = [(1, "a GRIEF of love"), (2, "glove"), (3, "an É X day"), (4, "none"), (5, None), (5, ""), (None, "slov"), (1, "a GRIEF of love")]
    got = labels.first_label(spark.createDataFrame(docs, "id int, t string"), ["id"], F.col("t"), spark.createDataFrame(listed, "place int, label string"))
    assert got.columns == ["id", "label"]
    assert sorted(map(str, rows(got))) == sorted(map(str, [
        (1, "Grief"), (1, "Grief"), (2, "Love"), (3, "é x"), (4, None), (5, None), (5, None), (None, "lov")]))
    assert rows(labels.first_label(spark.createDataFrame([(1, "x")], "id int, t string"), ["id"], F.col("t"),
                                   spark.createDataFrame([], "place int, label string"))) == [(1, None)]


def test_many_labels_against_brute_force(spark):
    rng = random.Random(8)
    known = [(i, "".join(rng.choices("abc ", k=rng.randrange(1, 9)))) for i in rng.sample(range(20_000), 3000)]
    texts = [(i, "".join(rng.choices("abcd ", k=rng.randrange(60)))) for i in range(200)]
    want = [(i, min(((p, v) for p, v in known if v in t), default=(None, None))[1]) for i, t in texts]
    found = labels.first_label(spark.createDataFrame(texts, "id int, t string"), ["id"], F.col("t"), spark.createDataFrame(known, "place int, label string"))
    first = {}
    for p, v in sorted(known):
        first.setdefault(v, p)
    assert [(i, v and first[v]) for i, v in rows(found, "id")] == [(i, v and first[v]) for i, v in want]


def test_stored_base_is_not_shuffled_again(spark, tmp_path):
    base = spark.createDataFrame([(i % 50 if i % 7 else None, 2000 + i % 3, i) for i in range(400)], "k int, y int, m long")
    fresh = spark.createDataFrame([(i if i % 9 else None, 2000 + i % 4, 1000 + i) for i in range(80)], "k int, y int, m long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = layout.store_bucketed(base, "layout_test", str(tmp_path / "t"), ["k", "y"], buckets=5)
        pairs = [(layout.refresh(stored, fresh, ["k", "y"], ["m"]), merge.refresh(base, fresh, ["k", "y"], ["m"])),
                 (layout.unmatched(fresh, stored, ["k", "y"]), merge.unmatched(fresh, base, ["k", "y"]))]
        for got, want in pairs:
            assert sorted(map(str, rows(got))) == sorted(map(str, rows(want))) and got.columns == want.columns
        again = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (None, 7, 3)], "k int, m long, load int")
        by_key = layout.store_bucketed(base.select("k", "m"), "layout_test_k", str(tmp_path / "k"), ["k"], buckets=5)
        assert sorted(map(str, rows(layout.patch(by_key, again, "k", ["m", "absent"], "load")))) == sorted(
            map(str, rows(merge.patch_columns(base.select("k", "m"), again, "k", ["m", "absent"], "load"))))
        whole = stored.where("k is not null and y is not null").join(fresh.where("k is not null and y is not null"), ["k", "y"])
        for plan in (whole, layout.refresh(stored, fresh, ["k", "y"], ["m"])):
            text_ = plan._jdf.queryExecution().executedPlan().toString()
            joined = text_.split("SortMergeJoin", 1)[1]
            left = joined.split("Scan parquet spark_catalog.default.layout_test", 1)[0]
            assert "Exchange" not in left and "Bucketed: true" in text_
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS layout_test")
        spark.sql("DROP TABLE IF EXISTS layout_test_k")
