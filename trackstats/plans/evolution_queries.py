"""Category-by-year tables, stacked layers, key ring and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import evolution
from .feature_queries import rounded
from .inputs import TRACKS, WORDS, tracks, words
from .registry import query

SHOWN = [c for c in vocab.CATEGORIES if c != "Other"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]


@query(f"WITH {TRACKS} SELECT key, mode, count(*) AS n FROM tracks GROUP BY ALL")
def two_key_counts(spark, folder):
    return evolution.two_key_counts(tracks(spark, folder))


RING = ", ".join(f"({i}, {k}, 1, '{vocab.KEY_NAMES[k]}'), ({i}, {(k + 9) % 12}, 0, '{vocab.KEY_NAMES[(k + 9) % 12]}m')"
                 for i, k in enumerate(vocab.CIRCLE_OF_FIFTHS))


@query(f"""WITH {TRACKS}, ring(ring_order, key, mode, label) AS (VALUES {RING}),
c AS (SELECT CASE WHEN key = 5 THEN 6 ELSE key END AS key, mode, count(*) AS n FROM tracks GROUP BY ALL)
SELECT r.ring_order, r.key, r.mode, r.label, coalesce(c.n, 0) AS n
FROM ring r LEFT JOIN c ON r.key = c.key AND r.mode = c.mode""")
def key_mode_circle(spark, folder):
    moved = F.when(F.col("key") == 5, 6).otherwise(F.col("key"))  # leaves an empty slot
    return evolution.key_ring(tracks(spark, folder).withColumn("key", moved))


WIDE = ", ".join(f"CAST(coalesce(sum(Frequency) FILTER (Category = '{c}'), 0) AS BIGINT) AS \"{c}\"" for c in SHOWN)


@query(f"WITH {WORDS} SELECT Year, {WIDE} FROM words GROUP BY Year")
def category_by_year(spark, folder):
    return evolution.category_by_year(words(spark, folder))


SHARES = ", ".join(f"round(count(*) FILTER (Topic = '{t}') / count(*) * 100, 6) AS \"{t}\"" for t in PART_TYPES[:4])


@query(f"""WITH {TRACKS} SELECT Year, {SHARES},
  round(count(*) FILTER (Topic NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO')) / count(*) * 100, 6) AS "Other"
FROM tracks GROUP BY Year""")
def topic_share_by_year(spark, folder):
    out = evolution.share_by_year(tracks(spark, folder), PART_TYPES[:4])
    return rounded(out, 6, *PART_TYPES[:4], "Other")


@query(f"""WITH {TRACKS}, e(event_year, event) AS (VALUES (1996, 'first'), (1999, 'second'), (2010, 'late')),
y AS (SELECT Year, count(*) AS n FROM tracks GROUP BY Year)
SELECT y.Year, y.n, e.event FROM y LEFT JOIN e ON y.Year = e.event_year AND e.event_year BETWEEN 1996 AND 2000""")
def event_annotation(spark, folder):
    yearly = tracks(spark, folder).groupBy("Year").agg(F.count(F.lit(1)).alias("n"))
    events = evolution.literal_table(spark, [(1996, "first"), (1999, "second"), (2010, "late")], ["event_year", "event"])
    return evolution.with_events(yearly, events, first=1996, last=2000)


EVENTS = ", ".join("({}, '{}', '{}')".format(y, *(t.replace("'", "''") for t in texts)) for y, *texts in vocab.INDUSTRY_EVENTS)


@query(f"""WITH {WORDS}, e(event_year, event, description) AS (VALUES {EVENTS}),
y AS (SELECT Year, CAST(sum(Frequency) AS BIGINT) AS n FROM words GROUP BY Year)
SELECT y.Year, y.n, e.event, e.description FROM y LEFT JOIN e ON y.Year = e.event_year""")
def industry_events(spark, folder):
    return evolution.with_events(words(spark, folder).groupBy("Year").agg(F.sum("Frequency").alias("n")))


TOTALS = WORDS + """, t AS (SELECT coalesce(nullif(Category, ''), 'other') AS category, CAST(sum(Frequency) AS BIGINT) AS value
  FROM (SELECT Word, Frequency, CASE WHEN Category = 'Time' THEN NULL ELSE Category END AS Category FROM words) GROUP BY 1)"""


@query(f"""WITH {TOTALS} SELECT category, value, round(value * 100.0E0 / sum(value) OVER (), 6) AS percent
FROM t WHERE value > 0 AND category <> 'Other' ORDER BY value DESC, category""")
def category_totals(spark, folder):
    w = words(spark, folder).withColumn("Category", F.when(F.col("Category") != "Time", F.col("Category")))
    return rounded(evolution.category_totals(w), 6, "percent")


# --- layers ---------------------------------------------------------------------


def _long(spark, folder):
    return evolution.melt(evolution.category_by_year(words(spark, folder)), "Year", SHOWN)


LONG = WORDS + f""", wide AS (SELECT Year, {WIDE} FROM words GROUP BY Year),
long AS (""" + " UNION ALL ".join(
    f"SELECT Year, {i} AS series_no, '{c}' AS series, \"{c}\" AS value FROM wide" for i, c in enumerate(SHOWN)) + ")"

STACK = """plain AS (SELECT *, CAST(sum(value) OVER (PARTITION BY Year ORDER BY series_no
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS y1 FROM long)"""

# The definition itself: for every year and series, half its own rise plus the
# rises of all series below, weighted by thickness.
BASELINE = """rises AS (SELECT b.Year, b.series_no, b.value, b.value - a.value AS rise
  FROM long b JOIN long a ON a.series_no = b.series_no AND a.Year = b.Year - 1),
sl AS (SELECT r.Year, r.value, r.rise / 2.0E0 + coalesce((SELECT sum(q.rise) FROM rises q
  WHERE q.Year = r.Year AND q.series_no < r.series_no), 0) AS slope FROM rises r),
st AS (SELECT Year, -sum(slope * value) / nullif(sum(value), 0) AS step FROM sl GROUP BY Year),
base AS (SELECT y.Year, coalesce((SELECT sum(st.step) FROM st WHERE st.Year <= y.Year), 0.0E0) AS baseline
  FROM (SELECT DISTINCT Year FROM long) y)"""


@query(f"WITH {LONG}, {STACK} SELECT Year, series_no, series, value, y1, y1 - value AS y0 FROM plain")
def stacked_layers(spark, folder):
    return evolution.stack_layers(_long(spark, folder))


@query(f"WITH {LONG}, {BASELINE} SELECT Year, round(baseline, 6) + 0.0E0 AS baseline FROM base")
def wiggle_baseline(spark, folder):
    return rounded(evolution.wiggle_baseline(_long(spark, folder)), 6, "baseline")


@query(f"""WITH {LONG}, {STACK}, {BASELINE} SELECT Year, series_no, series, value,
  round(y1 + baseline, 6) + 0.0E0 AS y1, round(y1 - value + baseline, 6) + 0.0E0 AS y0 FROM plain JOIN base USING (Year)""")
def stream_layers(spark, folder):
    return rounded(evolution.stack_layers(_long(spark, folder), offset="wiggle"), 6, "y0", "y1")


ORDER = """per AS (SELECT series, series_no, CAST(sum(value) AS DOUBLE) AS total,
  arg_min(Year, (-value, Year)) AS peak FROM long GROUP BY ALL),
seq AS (SELECT *, row_number() OVER (ORDER BY peak, series_no) AS k FROM per)"""


@query(f"""WITH RECURSIVE {LONG}, {ORDER}, walk(k, t, b, ordered) AS (
  SELECT CAST(0 AS BIGINT), 0.0E0, 0.0E0, CAST([] AS VARCHAR[])
  UNION ALL SELECT seq.k, CASE WHEN t < b THEN t + total ELSE t END, CASE WHEN t < b THEN b ELSE b + total END,
    CASE WHEN t < b THEN list_append(ordered, series) ELSE list_prepend(series, ordered) END
  FROM walk JOIN seq ON seq.k = walk.k + 1),
fin AS (SELECT ordered FROM walk ORDER BY k DESC LIMIT 1)
SELECT CAST(generate_subscripts(ordered, 1) - 1 AS INT) AS position, unnest(ordered) AS series FROM fin""")
def inside_out_order(spark, folder):
    return evolution.inside_out_order(_long(spark, folder))


STREAM = [*PART_TYPES[:4], "Other"]
STREAM_SQL = TRACKS + ", wide AS (SELECT Year, " + ", ".join(
    f"CAST(round(count(*) FILTER (Topic = '{t}') / count(*) * 1e6) AS BIGINT) AS \"{t}\"" for t in PART_TYPES[:4]) + """,
  CAST(round(count(*) FILTER (Topic NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO')) / count(*) * 1e6) AS BIGINT) AS "Other" FROM tracks GROUP BY Year),
given AS (""" + " UNION ALL ".join(f"SELECT Year, {i} AS series_no, '{c}' AS series, \"{c}\" AS value FROM wide" for i, c in enumerate(STREAM)) + ")"


@query(f"""WITH RECURSIVE {STREAM_SQL}, {ORDER.replace('FROM long', 'FROM given')}, walk(k, t, b, ordered) AS (
  SELECT CAST(0 AS BIGINT), 0.0E0, 0.0E0, CAST([] AS VARCHAR[])
  UNION ALL SELECT seq.k, CASE WHEN t < b THEN t + total ELSE t END, CASE WHEN t < b THEN b ELSE b + total END,
    CASE WHEN t < b THEN list_append(ordered, series) ELSE list_prepend(series, ordered) END
  FROM walk JOIN seq ON seq.k = walk.k + 1),
pos AS (SELECT CAST(generate_subscripts(ordered, 1) - 1 AS INT) AS series_no, unnest(ordered) AS series
  FROM (SELECT ordered FROM walk ORDER BY k DESC LIMIT 1)),
long AS (SELECT g.Year, pos.series_no, series, g.value FROM given g JOIN pos USING (series)), {STACK}, {BASELINE}
SELECT Year, series_no, series, value, round(y1 + baseline, 3) + 0.0E0 AS y1, round(y1 - value + baseline, 3) + 0.0E0 AS y0 FROM plain JOIN base USING (Year)""")
def topic_stream(spark, folder):
    """The topics' shares of every year, in inside-out order on the wiggle baseline; shares in millionths."""
    shares = evolution.share_by_year(tracks(spark, folder), PART_TYPES[:4])
    whole = shares.select("Year", *[F.round(F.col(c) * 10_000).cast("bigint").alias(c) for c in STREAM])
    long = evolution.melt(whole, "Year", STREAM)
    placed = evolution.reorder(long, evolution.inside_out_order(long)).select("Year", F.col("series_no"), "series", "value")
    return rounded(evolution.stack_layers(placed, offset="wiggle"), 3, "y0", "y1")


@query(f"""WITH {LONG}, {STACK}, m AS (SELECT *, max(value) OVER (PARTITION BY series) AS mx,
  avg(Year) OVER (PARTITION BY series) AS mid FROM plain),
best AS (SELECT * FROM m WHERE value >= mx * 0.5 QUALIFY row_number() OVER (PARTITION BY series ORDER BY abs(Year - mid), Year) = 1)
SELECT series, Year AS x, (y1 - value + y1) / 2.0E0 AS y, value AS thickness FROM best WHERE value > 10""")
def layer_labels(spark, folder):
    return evolution.label_anchors(evolution.stack_layers(_long(spark, folder)))


@query(f"""WITH {LONG}, {STACK}, m AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY Year) - 1 AS i,
  count(*) OVER (PARTITION BY series) AS c FROM plain)
SELECT series, Year, y1 - value AS y0, y1, value AS thickness FROM m WHERE i = floor(c / 2.0E0) AND value >= 3""")
def middle_labels(spark, folder):
    return evolution.middle_points(evolution.stack_layers(_long(spark, folder)))
