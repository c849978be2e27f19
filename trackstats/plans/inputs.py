"""The given tables in the shape of a media catalogue, for Spark and for the check SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import text as text_ops


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


FEATURES = ["danceability", "energy", "valence", "acousticness", "loudness", "tempo"]


#: More customers than these would shuffle the lines once more.
MANY = 50_000


def artist_and_title(artist: str, title: str) -> Column:
    return F.concat(artist, F.lit(" - "), title)


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: artist = customer, title = part, streams = price in cents.

    No join carries a hint: Spark broadcasts a dimension only if its size allows.
    Of many customers each meets the orders first, of which there are fewer than lines.
    """
    li, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    part, customer = table(spark, folder, "part"), table(spark, folder, "customer")
    on_order, on_part, on_customer = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey"), F.col("o_custkey") == F.col("c_custkey")
    if customer.count() > MANY:
        joined = li.join(part, on_part).join(orders.join(customer, on_customer), on_order)
    else:
        joined = li.join(orders, on_order).join(part, on_part).join(customer, on_customer)
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("track_id"),
        F.col("c_name").alias("Artist"), F.col("p_name").alias("Title"),
        artist_and_title("c_name", "p_name").alias("artist_title"),
        F.year("o_orderdate").cast("int").alias("Year"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("Streams"),
        (F.col("l_discount") * 10).alias("danceability"),
        (F.col("l_tax") / 0.08).alias("energy"),
        ((F.col("l_quantity") - 1) / 49).alias("valence"),
        ((F.col("p_size") - 1) / F.lit(49.0)).alias("acousticness"),
        (F.col("l_quantity") - 60).alias("loudness"),
        (F.col("p_size") * F.lit(4.0)).alias("tempo"),
        (F.col("l_quantity").cast("bigint") * 6000).alias("duration_ms"),
        (F.col("l_partkey") % 12).cast("int").alias("key"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("mode"),
        F.col("p_type").alias("Topic"), F.col("c_mktsegment").alias("Category"))


TRACKS = """tracks AS (
  SELECT concat(l.l_orderkey, '-', l.l_linenumber, '-', l.l_partkey, '-', l.l_suppkey) AS track_id,
         c.c_name AS Artist, p.p_name AS Title, concat(c.c_name, ' - ', p.p_name) AS artist_title,
         CAST(year(o.o_orderdate) AS INT) AS Year,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS Streams,
         l.l_discount * 10 AS danceability, l.l_tax / 0.08 AS energy,
         (l.l_quantity - 1) / 49 AS valence, (p.p_size - 1) / 49.0E0 AS acousticness,
         l.l_quantity - 60 AS loudness, p.p_size * 4.0E0 AS tempo,
         CAST(l.l_quantity AS BIGINT) * 6000 AS duration_ms,
         CAST(l.l_partkey % 12 AS INT) AS key,
         CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS mode,
         p.p_type AS Topic, c.c_mktsegment AS Category
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey JOIN customer c ON o.o_custkey = c.c_custkey)"""


def raw_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Tracks with missing values (zero features) and exact copies (one topic twice)."""
    df = tracks(spark, folder).withColumns({
        "energy": F.nullif(F.col("energy"), F.lit(0.0)),
        "danceability": F.nullif(F.col("danceability"), F.lit(0.0))})
    # One scan: rows of the copied topic are repeated in place.
    times = F.when(F.col("Topic") == "PROMO", 2).otherwise(1)
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), times))).drop("__copy")


RAW_TRACKS = TRACKS + """, nulled AS (
  SELECT * REPLACE (nullif(energy, 0) AS energy, nullif(danceability, 0) AS danceability) FROM tracks),
raw_tracks AS (SELECT * FROM nulled UNION ALL SELECT * FROM nulled WHERE Topic = 'PROMO')"""


# Every order is in the base, in the fresh rows, or in both.

def base_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").withColumn("Year", F.year("o_orderdate").cast("int"))
    return o.where((F.col("Year") <= 1999) & ((F.col("o_orderpriority") != "1-URGENT") | (F.col("Year") < 1997))).select(
        "o_orderkey", "Year", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("Streams"),
        F.lit(0).cast("bigint").alias("Daily"), F.col("o_orderpriority").alias("genre"))


def fresh_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").withColumn("Year", F.year("o_orderdate").cast("int"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    fresh = (F.col("Year") >= 1997) & ((F.col("o_orderstatus") != "F") | (F.col("o_orderpriority") == "1-URGENT") | (F.col("Year") > 1999))
    return o.where(fresh).select(
        "o_orderkey", "Year", (cents * 2).alias("Streams"), F.col("o_custkey").alias("Daily"))


ORDERS = """base AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS Year, CAST(round(o_totalprice * 100) AS BIGINT) AS Streams,
         CAST(0 AS BIGINT) AS Daily, o_orderpriority AS genre
  FROM orders WHERE year(o_orderdate) <= 1999 AND (o_orderpriority <> '1-URGENT' OR year(o_orderdate) < 1997)),
fresh AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS Year, CAST(round(o_totalprice * 100) AS BIGINT) * 2 AS Streams,
         o_custkey AS Daily
  FROM orders WHERE year(o_orderdate) >= 1997
    AND (o_orderstatus <> 'F' OR o_orderpriority = '1-URGENT' OR year(o_orderdate) > 1999))"""


#: Session setting: deal the documents out to so many tasks. For corpora in a few large row groups; unset, a scan's own tasks stay.
TEXT_PARTITIONS = "trackstats.textPartitions"


def lyrics(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    wanted = spark.conf.get(TEXT_PARTITIONS, None)
    if wanted:
        d = d.repartition(int(wanted))
    return d.select(
        "doc_id", (F.col("doc_id") % 16 + 2010).cast("int").alias("Year"), F.col("source").alias("Artist"),
        F.concat(F.lit("doc"), "doc_id").alias("Title"), F.col("lang").alias("language"),
        F.concat(F.lit("[Verse "), F.col("doc_id") % 3, F.lit("] "), "text").alias("Lyrics"))


LYRICS = """lyrics AS (
  SELECT doc_id, CAST(2010 + doc_id % 16 AS INT) AS Year, source AS Artist, concat('doc', doc_id) AS Title,
         lang AS language, concat('[Verse ', doc_id % 3, '] ', text) AS Lyrics
  FROM documents)"""

STOPWORD_SQL = ", ".join(f"'{w}'" for w in text_ops.DEFAULT_STOPWORDS)

CLEAN_SQL = (r"regexp_replace(regexp_replace(lower(Lyrics), '\[[^\n]*?\]', ' ', 'g'), "
             r"'[^\p{L}\p{N}_\s]', ' ', 'g')")
WORDS_SQL = rf"list_filter(string_split_regex({CLEAN_SQL}, '\s+'), lambda w: w <> '')"

COUNTS = LYRICS + rf""", toks AS (
  SELECT Year, unnest({WORDS_SQL}) AS word FROM lyrics WHERE language = 'en'),
counts AS (
  SELECT Year, word, count(*) AS n FROM toks
  WHERE length(word) >= 3 AND word NOT IN ({STOPWORD_SQL}) GROUP BY ALL)"""

CATEGORY_SQL = "list_extract([" + ", ".join(f"'{c}'" for c in vocab.CATEGORIES) + "], 1 + length(Word) % 13)"

WORDS = COUNTS + f""", words AS (
  SELECT Year, Word, Frequency, {CATEGORY_SQL} AS Category FROM (
    SELECT Year, word AS Word, n AS Frequency,
           row_number() OVER (PARTITION BY Year ORDER BY n DESC, word) AS r FROM counts) WHERE r <= 100)"""


def words(spark: SparkSession, folder: str) -> DataFrame:
    """The 100 most frequent words of every year with a category by word length."""
    top = text_ops.top_words(lyrics(spark, folder), 100, stem=None)
    names = F.array(*[F.lit(c) for c in vocab.CATEGORIES])
    return top.withColumn("Category", F.element_at(names, (F.length("Word") % 13 + 1).cast("int")))
