"""Batched enrichment: topics from a pluggable classifier, features from a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab
from .keys import best_per_key, lookup, once
from .merge import next_batch
from .scoring import scored
from .text import leading, spaced_words


def classify(df: DataFrame, fn: Callable, schema: str, *, parallelism: int | None = None) -> DataFrame:
    """Run a caller's batch function (pandas iterator to pandas iterator) on every partition.

    ``parallelism`` bounds the number of concurrent batches by the partition count.
    """
    src = df.repartition(parallelism) if parallelism else df
    return src.mapInPandas(fn, schema)


def finish_topics(df: DataFrame, raw: str, *, text: str = "Lyrics", topic: str = "Topic",
                  blank_topic: str = "Other") -> DataFrame:
    """Canonical topics from raw model answers; blank texts get a fixed topic, failures stay NULL."""
    # Made once: within a condition Spark would clean and lower a long answer again for every label.
    cleaned = once(once(df, __bare=S.without_marks(raw)), __low=F.lower("__bare"))
    label = S.contained_label(F.col("__low"), F.col("__bare"))
    return cleaned.withColumn(topic, F.when(S.is_blank(text), F.lit(blank_topic)).otherwise(label)).drop("__bare", "__low")


def keyword_topics(df: DataFrame, keywords: DataFrame, *, key: str, text: str = "Lyrics",
                   blank_topic: str = "Other") -> DataFrame:
    """``(key, Topic)`` of every row: the topic with the greatest weight of ``(word, topic, weight)`` hits.

    Blank texts get the fixed topic and texts without a keyword none. Ties go to
    the alphabetically first topic.
    """
    src = df.select(key, text, S.is_blank(text).alias("__blank"))
    model = keywords.select(F.col("word").alias("piece"), F.col("topic").alias("label"), "weight")
    found = scored(src, [key, "__blank"], spaced_words(text), model, kind="words")
    return found.select(key, F.when(F.col("__blank"), F.lit(blank_topic)).otherwise(leading(F.col("scores"))).alias("Topic"))


def topic_keywords(topics: list[str] = vocab.TOPICS) -> list[tuple[str, str, int]]:
    """Keyword rows from the words of the topic names themselves."""
    return [(w.lower(), t, 1) for t in topics for w in t.split() if len(w) > 3]


def feature_batch(df: DataFrame, features: DataFrame, *, key: str, flag: str, batch_size: int = 1500,
                  done: DataFrame | None = None) -> DataFrame:
    """The next batch with features attached; every row of it is flagged, found or not."""
    batch = next_batch(df, done, key, batch_size) if done is not None else df.orderBy(key).limit(batch_size)
    names = [c for c in features.columns if c != key]
    table = best_per_key(features, [key], [F.col(c).asc_nulls_last() for c in names])
    kept = batch.drop(*[c for c in names if c in batch.columns], flag)
    return lookup(kept, table, [key], "left").withColumn(flag, F.lit(True))
