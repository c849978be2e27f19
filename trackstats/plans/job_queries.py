"""The catalogue's jobs end to end: refresh from stored pages, charts of a selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.select import Selection
from . import jobs
from .catalogue_queries import page_tracks, stored_chart_pages
from .evolution_queries import RING
from .feature_queries import STAT_FEATURES, STATS_SQL, TIMED, rounded, timed_tracks
from .inputs import TRACKS, artist_and_title, words
from .registry import query

# Every title of the pages that is in the base once, without a measure; years from 1997 on are new.
REFRESH = TRACKS + """, fresh AS (SELECT concat(artist_title, 'éé– &lt;') AS "Artist and Title", Artist,
  concat(Title, 'éé– &lt;') AS Title, Streams, duration_ms AS Daily, Year FROM tracks),
base AS (SELECT DISTINCT concat(artist_title, 'éé– &lt;') AS "Artist and Title", Year, CAST(0 AS BIGINT) AS Streams, CAST(0 AS BIGINT) AS Daily, Topic AS genre
  FROM tracks WHERE Year < 1997 AND Topic <> 'SMALL')"""


def _refreshed(spark, folder):
    """Base and pages come from the same tracks, which are made and stored once, when this is called."""
    made = page_tracks(spark, folder, "Topic")
    title = F.concat(artist_and_title("Artist", "Title"), F.lit("éé– &lt;"))
    known = made.where((F.col("Year") < 1997) & (F.col("Topic") != "SMALL"))
    none = F.lit(0).cast("bigint")
    base = known.select(title.alias("Artist and Title"), "Year", none.alias("Streams"), none.alias("Daily"), F.col("Topic").alias("genre")).distinct()
    return jobs.refresh_catalogue(base, stored_chart_pages(spark, folder, made))


@query(f"""WITH {REFRESH} SELECT b."Artist and Title", b.Year, f.Streams, f.Daily, b.genre, CAST(NULL AS VARCHAR) AS Artist, CAST(NULL AS VARCHAR) AS Title
FROM base b JOIN fresh f USING ("Artist and Title", Year)
UNION ALL BY NAME SELECT * FROM fresh WHERE Year NOT IN (SELECT Year FROM base)""")
def catalogue_refresh(spark, folder):
    return _refreshed(spark, folder)[0]


@query(f"""WITH {REFRESH}, u AS (SELECT 1 FROM base b JOIN fresh f USING ("Artist and Title", Year)) SELECT
  (SELECT count(*) FROM u) AS n_updated, (SELECT count(*) FROM base WHERE Year IN (SELECT Year FROM fresh)) - (SELECT count(*) FROM u) AS n_unmatched,
  (SELECT count(*) FROM fresh f WHERE Year IN (SELECT Year FROM base) AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b."Artist and Title" = f."Artist and Title" AND b.Year = f.Year)) AS n_new_in_shared,
  (SELECT count(*) FROM fresh WHERE Year NOT IN (SELECT Year FROM base)) AS n_new_years""")
def catalogue_refresh_report(spark, folder):
    return _refreshed(spark, folder)[1]


CHOSEN = TIMED + ", chosen AS (SELECT * FROM timed WHERE Year = 1998 AND abs(valence - 0.5E0) <= 0.15E0)"


def _dashboard(spark, folder):
    return jobs.Dashboard(timed_tracks(spark, folder), words(spark, folder), STAT_FEATURES, Selection(year=1998, bands={"valence": 0.5})).charts()


@query(f"""WITH {CHOSEN} SELECT Artist, CAST(sum(Streams) AS BIGINT) AS streams, count(*) AS songs FROM chosen
GROUP BY Artist ORDER BY streams DESC, Artist LIMIT 10""")
def dashboard_artists(spark, folder):
    return _dashboard(spark, folder)["artists"]


@query(f"WITH {CHOSEN}, st AS ({STATS_SQL.replace('FROM timed WHERE Year = 1998', 'FROM chosen')}) "
       "SELECT feature, min, max, mean FROM st")
def dashboard_stats(spark, folder):
    return rounded(_dashboard(spark, folder)["stats"], 6, "mean")


@query(f"""WITH {CHOSEN}, ring(ring_order, key, mode, label) AS (VALUES {RING}),
c AS (SELECT key, mode, count(*) AS n FROM chosen GROUP BY ALL)
SELECT r.ring_order, r.key, r.mode, r.label, coalesce(c.n, 0) AS n FROM ring r LEFT JOIN c ON r.key = c.key AND r.mode = c.mode""")
def dashboard_key_ring(spark, folder):
    return _dashboard(spark, folder)["key_ring"]


@query(f"""WITH {CHOSEN}, i AS (SELECT track_id, row_number() OVER (ORDER BY track_id) - 1 AS i, count(*) OVER () AS n FROM chosen)
SELECT track_id FROM i WHERE i % greatest(CAST(ceil(n / 1500.0E0) AS BIGINT), 1) = 0""")
def dashboard_parallel(spark, folder):
    return _dashboard(spark, folder)["parallel"].select("track_id")


@query(f"""WITH {TIMED}, m AS (SELECT Year, {', '.join(f'avg({f}) AS {f}' for f in STAT_FEATURES)} FROM timed GROUP BY Year)
SELECT Year, {', '.join(f'round({f}, 6) + 0.0E0 AS {f}' for f in STAT_FEATURES)} FROM m""")
def dashboard_trend(spark, folder):
    return rounded(_dashboard(spark, folder)["trend"], 6, *STAT_FEATURES)
