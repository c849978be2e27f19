"""Feature statistics, densities, rankings and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab
from ..operators import density, rank, stats
from ..operators.ordering import By
from ..operators.select import Selection
from .inputs import RAW_TRACKS, TRACKS, raw_tracks, table, tracks
from .registry import query

UNIT = ["danceability", "energy", "valence", "acousticness"]
STAT_FEATURES = [*UNIT, "loudness", "tempo", "duration_min"]


def rounded(df, places: int, *columns: str):
    """Fix the last digits of sums whose order is free; no negative zero."""
    return df.withColumns({c: F.round(F.col(c), places) + F.lit(0.0) for c in columns})


def settled(df, column: str):
    """Six decimals; the offset moves exact halves, which densities of dyadic values often are."""
    return df.withColumn(column, F.round(F.col(column) + 1e-10, 6))


def timed_tracks(spark, folder):
    return tracks(spark, folder).withColumn("duration_min", S.minutes("duration_ms"))


TIMED = TRACKS + ", timed AS (SELECT *, duration_ms / 60000.0E0 AS duration_min FROM tracks)"


def _stat_sql(feature: str) -> str:
    low, high, _ = vocab.FEATURE_BOUNDS[feature]
    lo = f"{low}E0" if low is not None else f"min({feature})"
    hi = f"{high}E0" if high is not None else f"(SELECT max({feature}) FROM timed)"
    return (f"SELECT '{feature}' AS feature, {lo} AS min, {hi} AS max, "
            f"round(avg({feature}), 6) AS mean FROM timed WHERE Year = 1998")


STATS_SQL = " UNION ALL ".join(_stat_sql(f) for f in STAT_FEATURES)


@query(f"WITH {TIMED} {STATS_SQL}")
def feature_bounds(spark, folder):
    df = timed_tracks(spark, folder)
    return rounded(stats.feature_stats(df, Selection(year=1998).tracks(df), STAT_FEATURES), 6, "mean")


@query(f"""WITH {TRACKS}, y AS (SELECT Year + CASE WHEN Year % 2 = 0 THEN 10 ELSE 0 END AS Year, avg(energy) AS energy, avg(tempo) AS tempo FROM tracks GROUP BY ALL)
SELECT CAST(s.Year AS INT) AS Year, round(coalesce(y.energy, 0), 6) AS energy, round(coalesce(y.tempo, 0), 6) AS tempo
FROM (SELECT unnest(generate_series(min(Year), max(Year))) AS Year FROM y) s LEFT JOIN y ON s.Year = y.Year""")
def yearly_means_dense(spark, folder):
    moved = F.col("Year") + F.when(F.col("Year") % 2 == 0, 10).otherwise(0)  # leaves empty years
    df = tracks(spark, folder).withColumn("Year", moved)
    return rounded(stats.yearly_means(df, ["energy", "tempo"]), 6, "energy", "tempo")


@query(f"""WITH {RAW_TRACKS} SELECT CASE WHEN grouping(Year) = 1 THEN 'All Time' ELSE CAST(Year AS VARCHAR) END AS period,
  count(*) AS n, round(avg(energy), 6) AS mean_energy, round(avg(tempo), 6) AS mean_tempo
FROM raw_tracks GROUP BY GROUPING SETS ((Year), ())""")
def yearly_and_all_time(spark, folder):
    out = stats.means_with_total(raw_tracks(spark, folder), ["energy", "tempo"])
    return rounded(out, 6, "mean_energy", "mean_tempo")


@query(f"""WITH {RAW_TRACKS} SELECT count(*) AS n, round(avg(energy), 6) AS mean_x, round(avg(danceability), 6) AS mean_y
FROM raw_tracks WHERE energy IS NOT NULL AND danceability IS NOT NULL""")
def selection_summary(spark, folder):
    return rounded(stats.selection_summary(raw_tracks(spark, folder), "energy", "danceability"), 6, "mean_x", "mean_y")


CORR_FEATURES = ["acousticness", "danceability", "energy", "key", "loudness", "mode", "tempo", "valence", "duration_ms"]
CORR_SQL = " UNION ALL ".join(
    f"""SELECT '{a}' AS feature_x, '{b}' AS feature_y, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n,
  round(covar_pop({a}, {b}) / nullif(sqrt(var_pop({a}) FILTER ({b} IS NOT NULL) * var_pop({b}) FILTER ({a} IS NOT NULL)), 0), 6)
  + 0.0E0 AS r FROM c""" for a in CORR_FEATURES for b in CORR_FEATURES)


@query(f"WITH {RAW_TRACKS}, c AS MATERIALIZED (SELECT "
       + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in CORR_FEATURES) + f" FROM raw_tracks) {CORR_SQL}")
def correlation_matrix(spark, folder):
    return rounded(stats.correlation(raw_tracks(spark, folder), vocab.CORRELATED_FEATURES), 6, "r")


@query(f"""WITH {RAW_TRACKS} SELECT CASE
  WHEN valence >= 0.5 AND energy >= 0.5 THEN 'Euphoric Anthems' WHEN energy >= 0.5 THEN 'Dark & Aggressive'
  WHEN valence >= 0.5 THEN 'Chill & Breezy' ELSE 'Melancholy Heartbreak' END AS quadrant, count(*) AS n
FROM raw_tracks WHERE energy IS NOT NULL GROUP BY ALL""")
def quadrant_counts(spark, folder):
    return stats.quadrant_counts(raw_tracks(spark, folder), "valence", "energy")


PROFILE_SQL = " UNION ALL ".join(
    f"SELECT track_id, '{f}' AS axis, round(({f} - b.min) / (b.max - b.min), 6) AS value, {f} AS originalValue "
    f"FROM timed, (SELECT min, max FROM st WHERE feature = '{f}') b WHERE Year = 1998" for f in STAT_FEATURES)


@query(f"WITH {TIMED}, st AS ({STATS_SQL}) {PROFILE_SQL}")
def radar_profile(spark, folder):
    df = timed_tracks(spark, folder)
    st = stats.feature_stats(df, df, STAT_FEATURES)
    return rounded(stats.profile(Selection(year=1998).tracks(df), st, STAT_FEATURES, "track_id"), 6, "value")


@query(f"""WITH {TIMED}, st AS ({STATS_SQL}) SELECT 'average' AS track_id, feature AS axis,
  round((mean - min) / (max - min), 4) AS value FROM st""")
def radar_average(spark, folder):
    df = timed_tracks(spark, folder)
    st = stats.feature_stats(df, Selection(year=1998).tracks(df), STAT_FEATURES)
    return rounded(stats.mean_profile(st, "track_id"), 4, "value").drop("originalValue")


@query(f"""WITH {TRACKS}, m AS (SELECT max(Streams) AS top, max(tempo) AS fast FROM tracks)
SELECT track_id, round(sqrt(Streams) / sqrt(top) * 20 + 2, 6) AS mark_size, round(tempo / fast, 6) AS mark_color
FROM tracks, m""")
def mark_encoding(spark, folder):
    df = tracks(spark, folder)
    out = stats.encode_marks(df, "Streams", "tempo", df)
    return rounded(out.select("track_id", "mark_size", "mark_color"), 6, "mark_size", "mark_color")


@query(f"""WITH {TRACKS}, p AS (SELECT track_id, key * pi() / 6 - pi() / 2 AS a, valence * 100 AS r FROM tracks)
SELECT track_id, round(r * cos(a), 6) + 0.0E0 AS px, round(r * sin(a), 6) + 0.0E0 AS py FROM p""")
def polar_positions(spark, folder):
    px, py = S.polar_point("key", F.col("valence") * 2 - 1, 100.0)
    return rounded(tracks(spark, folder).select("track_id", px.alias("px"), py.alias("py")), 6, "px", "py")


@query(f"""WITH {TRACKS} SELECT count(DISTINCT Year) AS n_values, min(Year) AS first_value, max(Year) AS last_value
FROM tracks""")
def year_range(spark, folder):
    return stats.distinct_range(tracks(spark, folder), "Year")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang")
def language_counts(spark, folder):
    return stats.value_counts(table(spark, folder, "documents"), "lang")


@query(f"""WITH {TIMED}, d AS (SELECT *, CAST(floor(duration_min) AS BIGINT) AS m,
  CAST(floor((duration_min - floor(duration_min)) * 60 + 0.5) AS BIGINT) AS s FROM timed)
SELECT track_id, concat(m, '.', lpad(CAST(s AS VARCHAR), 2, '0')) AS duration,
  CAST(CAST(tempo AS BIGINT) AS VARCHAR) AS tempo, concat(chr(8722), CAST(CAST(abs(loudness) AS BIGINT) AS VARCHAR), '.00') AS loudness,
  CASE WHEN mode = 0 THEN concat(k, 'm') ELSE k END AS key_label,
  CASE WHEN length(Title) > 8 THEN concat(left(Title, 6), '...') ELSE Title END AS short_title,
  CASE Topic WHEN 'PROMO' THEN 'Duration (min)' WHEN 'SMALL' THEN 'Flesch Kincaid Grade' ELSE 'Acousticness' END AS label
FROM (SELECT *, list_extract(['C','C#/Db','D','D#/Eb','E','F','F#/Gb','G','G#','A','A#/Bb','B'], key + 1) AS k FROM d)""")
def display_labels(spark, folder):
    name = (F.when(F.col("Topic") == "PROMO", F.lit("duration_min"))
            .when(F.col("Topic") == "SMALL", F.lit("Flesch_Kincaid_Grade")).otherwise(F.lit("acousticness")))
    return timed_tracks(spark, folder).select(
        "track_id", S.duration_text("duration_min").alias("duration"),
        S.feature_text(F.lit("tempo"), "tempo").alias("tempo"), S.feature_text(F.lit("loudness"), "loudness").alias("loudness"),
        S.key_name("key", "mode").alias("key_label"), S.abbreviate("Title", 8).alias("short_title"),
        S.title_label(name).alias("label"))


# --- density ---------------------------------------------------------------------

KDE_LONG = " UNION ALL ".join(f"SELECT Year, '{f}' AS feature, {f} AS v FROM tracks" for f in UNIT)


def _kde_sql(h: str, group: str) -> str:
    """Every grid point against every distinct value, weighted by its count."""
    g = f"{group}, " if group else ""
    return f"""vals AS (SELECT {g}feature, v, count(*) AS n FROM long GROUP BY ALL),
grid AS (SELECT unnest(range(0, 51)) / 50.0E0 AS x),
curve AS (SELECT {g}feature, x, sum(CASE WHEN abs((x - v) / {h}) <= 1
    THEN n * 0.75E0 * (1 - ((x - v) / {h}) * ((x - v) / {h})) / {h} ELSE 0 END) / sum(n) AS density
  FROM vals, grid GROUP BY ALL)"""


@query(f"""WITH {TRACKS}, long AS ({KDE_LONG}), {_kde_sql('0.04E0', 'Year')}
SELECT Year, feature, x, round(density + 1e-10, 6) AS density FROM curve""")
def kde_by_year(spark, folder):
    return settled(density.density(tracks(spark, folder), UNIT, h=0.04, group=["Year"]), "density").drop("n_values")


@query(f"""WITH {TRACKS}, long AS ({KDE_LONG}), {_kde_sql('0.12E0', '')}
SELECT feature, x, round(density + 1e-10, 6) AS density FROM curve""")
def kde_distribution(spark, folder):
    return settled(density.density(tracks(spark, folder), UNIT, h=0.12), "density").drop("n_values")


@query(f"""WITH {TRACKS}, long0 AS ({KDE_LONG}), long AS (
  SELECT CAST(Year AS VARCHAR) AS period, feature, v FROM long0 UNION ALL SELECT 'All Time', feature, v FROM long0),
{_kde_sql('0.04E0', 'period')} SELECT period, feature, x, round(density + 1e-10, 6) AS density FROM curve""")
def ridgeline(spark, folder):
    return settled(density.density_with_total(tracks(spark, folder), UNIT, group="Year"), "density")


WIDE_FEATURES = ["tempo", "loudness", "duration_min"]
WIDE_LONG = (" UNION ALL ".join(f"SELECT Year, '{f}' AS feature, {f} AS raw FROM timed" for f in WIDE_FEATURES))


@query(f"""WITH {TIMED}, st AS ({STATS_SQL}), raw AS ({WIDE_LONG}),
long AS (SELECT Year, r.feature, (raw - min) / nullif(max - min, 0) AS v FROM raw r JOIN st ON r.feature = st.feature),
{_kde_sql('0.12E0', 'Year')} SELECT Year, feature, x, round(density + 1e-10, 6) AS density FROM curve""")
def kde_of_any_domain(spark, folder):
    df = timed_tracks(spark, folder)
    bounds = stats.feature_stats(df, df, STAT_FEATURES)
    curves = density.density(df, WIDE_FEATURES, h=0.12, group=["Year"], bounds=bounds)
    return settled(curves, "density").drop("n_values")


@query(f"""WITH {TRACKS}, long AS ({KDE_LONG}), {_kde_sql('0.12E0', '')}
SELECT round(max(density) + 1e-10, 6) AS max_density FROM curve""")
def kde_axis_limit(spark, folder):
    return settled(density.shared_maximum(density.density(tracks(spark, folder), UNIT, h=0.12)), "max_density")


@query(f"""WITH {TRACKS}, long AS (SELECT 'valence' AS feature, valence AS v FROM tracks), {_kde_sql('0.12E0', '')}
SELECT track_id, valence, x AS curve_x, round(density + 1e-10, 6) AS density FROM tracks
JOIN curve ON CAST(round(x * 50) AS BIGINT) = least(ceil(round(valence * 50, 9)), 50)""")
def density_lookup(spark, folder):
    df = tracks(spark, folder)
    curve = density.density(df, ["valence"], h=0.12)
    out = density.density_at(df.select("track_id", "valence"), curve, "valence")
    return settled(out, "density")


@query(f"""WITH {TRACKS}, long AS (SELECT 'valence' AS feature, valence AS v FROM tracks), {_kde_sql('0.12E0', '')},
uneven AS (SELECT x + 0.0013E0 AS x, density FROM curve WHERE CAST(round(x * 50) AS BIGINT) % 7 IN (0, 1, 4)),
asked AS (SELECT track_id, valence * 1.4E0 - 0.2E0 AS valence FROM tracks),
found AS (SELECT a.track_id, a.valence, u.x, u.density FROM asked a ASOF LEFT JOIN uneven u ON a.valence <= u.x)
SELECT track_id, round(valence, 9) AS valence, round(coalesce(x, (SELECT max(x) FROM uneven)), 9) AS curve_x,
  round(coalesce(density, (SELECT arg_max(density, x) FROM uneven)) + 1e-10, 6) AS density FROM found""")
def density_lookup_any_grid(spark, folder):
    """Values within, between and beyond the points of an uneven grid."""
    df = tracks(spark, folder)
    curve = density.density(df, ["valence"], h=0.12)
    uneven = curve.where((F.round(F.col("x") * 50).cast("bigint") % 7).isin(0, 1, 4))
    asked = df.select("track_id", (F.col("valence") * 1.4 - 0.2).alias("valence"))
    out = density.density_as_of(asked, uneven.withColumn("x", F.col("x") + 0.0013), "valence")
    return rounded(settled(out, "density"), 9, "valence", "curve_x")


@query(f"""WITH {TRACKS}, b AS (SELECT least(floor(round(acousticness * 20, 9)), 19) AS i, count(*) AS n FROM tracks GROUP BY 1)
SELECT s.i / 20.0E0 AS x0, (s.i + 1) / 20.0E0 AS x1, coalesce(n, 0) AS n
FROM (SELECT unnest(range(0, 20)) AS i) s LEFT JOIN b ON s.i = b.i""")
def histogram(spark, folder):
    return density.histogram(tracks(spark, folder), "acousticness", bins=25)


@query(f"""WITH {TRACKS}, s AS (SELECT loudness / 40.0E0 + 0.5E0 AS v FROM tracks),
b AS (SELECT least(floor(round(v * 20, 9)), 19) AS i, count(*) AS n FROM s WHERE v BETWEEN 0 AND 1 GROUP BY 1)
SELECT s.i / 20.0E0 AS x0, (s.i + 1) / 20.0E0 AS x1, coalesce(n, 0) AS n, round((SELECT avg(v) FROM s), 6) AS mean
FROM (SELECT unnest(range(0, 20)) AS i) s LEFT JOIN b ON s.i = b.i""")
def histogram_mean(spark, folder):
    """Part of the values lie outside the bins; they count in the mean."""
    df = tracks(spark, folder).select((F.col("loudness") / 40.0 + 0.5).alias("v"))
    return rounded(density.histogram_with_mean(df, "v", bins=25), 6, "mean")


SURFACE = """n2 AS (SELECT CAST(least(floor((tempo - 0.0E0) / (200.0E0 / 40)), 39) AS INT) AS cx,
    CAST(least(floor((valence - 0.0E0) / (1.0E0 / 40)), 39) AS INT) AS cy, count(*) AS n FROM tracks GROUP BY ALL),
surface AS (SELECT CAST(cx + dx AS INT) AS bx, CAST(cy + dy AS INT) AS "by",
    CAST(sum(n * (16 - dx * dx) * (16 - dy * dy)) AS BIGINT) AS weight
  FROM n2, (SELECT unnest(range(-3, 4)) AS dx), (SELECT unnest(range(-3, 4)) AS dy)
  WHERE cx + dx BETWEEN 0 AND 39 AND cy + dy BETWEEN 0 AND 39 GROUP BY ALL)"""


def _surface(df):
    return density.density_2d(df, "tempo", "valence", x_domain=(0.0, 200.0), y_domain=(0.0, 1.0))


@query(f"""WITH {TRACKS}, {SURFACE} SELECT bx, "by", round((bx + 0.5) * 5.0E0, 6) AS x, round(("by" + 0.5) * 0.025E0, 6) AS y,
  weight FROM surface""")
def density_surface(spark, folder):
    return rounded(_surface(tracks(spark, folder)), 6, "x", "y")


@query(f"""WITH {TRACKS}, {SURFACE}, pk AS (SELECT (bx + 0.5) * 5.0E0 AS x, ("by" + 0.5) * 0.025E0 AS y FROM surface
  ORDER BY weight DESC, bx, "by" LIMIT 1)
SELECT track_id, tempo, valence FROM tracks, pk
ORDER BY round(((tempo - x) / 200) * ((tempo - x) / 200) + (valence - y) * (valence - y), 9), track_id LIMIT 1""")
def nearest_to_peak(spark, folder):
    df = tracks(spark, folder)
    best = density.peak(_surface(df))
    found = density.nearest(df, "tempo", "valence", best, x_span=200.0, y_span=1.0, ties=["track_id"])
    return found.select("track_id", "tempo", "valence")


@query(f"""WITH {TRACKS} SELECT track_id,
  CASE WHEN tempo > 100 THEN CAST(CAST(tempo AS BIGINT) AS VARCHAR) ELSE concat(CAST(CAST(tempo AS BIGINT) AS VARCHAR), '.00') END AS summary,
  CASE Topic WHEN 'PROMO' THEN 'Instr.' WHEN 'SMALL' THEN 'Dance.' ELSE 'Energy' END AS short,
  CASE WHEN Topic = 'LARGE' THEN NULL ELSE Year END AS year_number, (key + 9) % 12 AS minor,
  CASE WHEN Topic = 'ECONOMY' THEN lpad(CAST(Streams AS VARCHAR), 22, '0') END AS bare_id FROM tracks""")
def detail_texts(spark, folder):
    """Summaries, short labels, whole numbers from text such as '1997.0', relative minors, bare ids."""
    p = F.col("Topic")
    name = F.when(p == "PROMO", F.lit("Instrumentalness")).when(p == "SMALL", F.lit("Danceability")).otherwise(F.lit("Energy"))
    year = F.when(p == "LARGE", F.lit("unknown")).otherwise(F.concat(F.lit(" "), F.col("Year").cast("string"), F.lit(".0")))
    link = F.when(p == "ECONOMY", F.lpad(F.col("Streams").cast("string"), 22, "0")).otherwise(F.lit("spotless"))
    return tracks(spark, folder).select(
        "track_id", S.summary_text("tempo", F.col("tempo")).alias("summary"), S.short_label(name).alias("short"),
        S.as_int(year).alias("year_number"), S.relative_minor("key").cast("int").alias("minor"), S.id_from_url(link).alias("bare_id"))


# --- rankings and samples ----------------------------------------------------------


@query(f"""WITH {TRACKS}, a AS (SELECT Year, Artist, CAST(sum(Streams) AS BIGINT) AS streams, count(*) AS songs
  FROM tracks GROUP BY ALL)
SELECT Year, CAST(row_number() OVER (PARTITION BY Year ORDER BY streams DESC, Artist) AS INT) AS rank, Artist, streams, songs
FROM a QUALIFY rank <= 10""")
def artist_leaderboard_by_year(spark, folder):
    return rank.leaderboard(tracks(spark, folder))


@query(f"WITH {TRACKS} SELECT Artist, CAST(sum(Streams) AS BIGINT) AS streams, count(*) AS songs FROM tracks GROUP BY Artist")
def artist_totals(spark, folder):
    return rank.totals(tracks(spark, folder))


@query(f"""WITH {TRACKS} SELECT Artist, CAST(sum(Streams) AS BIGINT) AS streams, count(*) AS songs FROM tracks
GROUP BY Artist ORDER BY streams DESC, Artist LIMIT 10""")
def top_artists(spark, folder):
    return rank.top_total(tracks(spark, folder))


@query(f"WITH {TRACKS} SELECT track_id, Title, Streams FROM tracks WHERE Artist = 'Customer#000000007'")
def artist_songs(spark, folder):
    return rank.members(tracks(spark, folder), "Artist", "Customer#000000007", ["track_id", "Title", "Streams"])


@query(f"""WITH {TRACKS}, a AS (SELECT Artist, CAST(sum(Streams) AS BIGINT) AS streams FROM tracks GROUP BY ALL)
SELECT Artist, streams, row_number() OVER (ORDER BY streams DESC, Artist) AS rank FROM a""")
def artist_rank(spark, folder):
    return rank.overall_rank(tracks(spark, folder))


@query(f"""WITH {TRACKS}, i AS (SELECT track_id, Streams, row_number() OVER (ORDER BY Streams DESC, track_id) - 1 AS i,
  count(*) OVER () AS n FROM tracks)
SELECT track_id, Streams FROM i WHERE i % greatest(CAST(ceil(n / 1500.0E0) AS BIGINT), 1) = 0""")
def nth_sample(spark, folder):
    df = tracks(spark, folder).select("track_id", "Streams")
    return rank.every_nth(df, [By("Streams", descending=True), "track_id"])


@query("""SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY source, doc_id) - 1) / 20.0E0) + 1 AS BIGINT) AS batch
FROM documents""")
def batch_numbers(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return rank.batch_numbers(docs, ["source", "doc_id"]).select("doc_id", "batch")
