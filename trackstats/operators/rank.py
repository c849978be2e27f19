"""Totals per key, leaderboards, top-k and deterministic samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import top_n
from .ordering import By, Order, with_row_index


def totals(df: DataFrame, key: str = "Artist", measure: str = "Streams") -> DataFrame:
    """Sum and row count per key; partial sums combine before the shuffle."""
    return df.groupBy(key).agg(F.sum(measure).alias("streams"), F.count(F.lit(1)).alias("songs"))


def top_total(df: DataFrame, n: int = 10, *, key: str = "Artist", measure: str = "Streams") -> DataFrame:
    return totals(df, key, measure).orderBy(F.col("streams").desc(), F.col(key).asc_nulls_last()).limit(n)


def members(df: DataFrame, key: str, value, columns: list[str]) -> DataFrame:
    """The rows behind one key: the drill-down instead of a collected list."""
    return df.where(F.col(key) == value).select(*columns)


def leaderboard(df: DataFrame, n: int = 10, *, year: str = "Year", key: str = "Artist",
                measure: str = "Streams") -> DataFrame:
    """``(year, rank, key, streams, songs)``: the leaders of every year in one job."""
    per = df.groupBy(year, key).agg(F.sum(measure).alias("streams"), F.count(F.lit(1)).alias("songs"))
    order = [F.col("streams").desc(), F.col(key).asc_nulls_last()]
    out = top_n(per, [year], order, n, rank="rank")
    return out.select(year, "rank", key, "streams", "songs")


def overall_rank(df: DataFrame, *, key: str = "Artist", measure: str = "Streams") -> DataFrame:
    """``(key, streams, rank)`` of every key, numbered across partitions."""
    per = df.groupBy(key).agg(F.sum(measure).alias("streams"))
    order = [By("streams", descending=True, nulls_last=True), By(key, nulls_last=True)]
    return with_row_index(per, order, "__i").select(key, "streams", (F.col("__i") + 1).alias("rank"))


def every_nth(df: DataFrame, order: Order, cap: int = 1500) -> DataFrame:
    """All rows up to the cap; beyond it every ceil(n / cap)-th in the given order."""
    indexed = with_row_index(df, order, "__i")
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    step = F.greatest(F.ceil(n / F.lit(float(cap))), F.lit(1)).cast("bigint")
    return indexed.where(F.col("__i") % step == 0).drop("__i")


def batch_numbers(df: DataFrame, order: Order, size: int = 20) -> DataFrame:
    """Consecutive batches of ``size`` rows, counted from 1."""
    indexed = with_row_index(df, order, "__i")
    return indexed.withColumn("batch", (F.floor(F.col("__i") / size) + 1).cast("bigint")).drop("__i")


def words_by_category(words: DataFrame, n: int = 7, *, year: str = "Year", category: str = "Category",
                      word: str = "Word", count: str = "Frequency") -> DataFrame:
    """The most frequent words per (year, category) as one sorted array."""
    order = [F.col(count).desc(), F.col(word).asc_nulls_last()]
    best = top_n(words, [year, category], order, n, rank="pos")
    ordered = F.sort_array(F.collect_list(F.struct("pos", word, count)))  # at most n entries
    return best.groupBy(year, category).agg(
        F.transform(ordered, lambda s: F.struct(s[word].alias(word), s[count].alias(count))).alias("words"))
