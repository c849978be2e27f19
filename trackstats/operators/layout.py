"""Tables stored in buckets of their key, so that jobs which come back to them do not shuffle them again.

A catalogue is written once, dealt and sorted by its key. Refreshes, searches for
new rows and patches then shuffle only what is new, into the same buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import last_per_key


def store_bucketed(df: DataFrame, name: str, path: str, keys: list[str], *, buckets: int | None = None) -> DataFrame:
    """Write a table in buckets of ``keys`` and return it; ``buckets`` is the parallelism of the jobs to come.

    Rows are dealt to the buckets before they are written, so there is one file a bucket.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, *keys).write.mode("errorifexists").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return spark.table(name)


def _whole(df: DataFrame, keys: list[str], whole: bool) -> DataFrame:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return df.where(known if whole else ~known)


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join in which NULL keys match; keys without NULL meet by plain equality, as buckets need it."""
    plain = _whole(left, keys, True).join(_whole(right, keys, True), keys, how).select(*_columns(left, right, keys, how))
    other = _whole(right, keys, False).withColumnsRenamed({k: f"__{k}" for k in keys})
    rest, on = _whole(left, keys, False), F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return plain.unionByName(rest.join(other, on, how).select(*_columns(left, right, keys, how)))


def _columns(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> list[str]:
    more = [] if how in ("left_anti", "left_semi") else [c for c in right.columns if c not in keys]
    return [*left.columns, *more]


def refresh(stored: DataFrame, fresh: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Rows of the stored table with a fresh counterpart, their measures replaced; a key repeated on both sides multiplies."""
    new = fresh.select(*keys, *[F.col(m).alias(f"__new_{m}") for m in measures])
    found = _join(stored, new, keys, "inner")
    return found.select(*[F.col(f"__new_{c}").alias(c) if c in measures else F.col(c) for c in stored.columns])


def unmatched(fresh: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Fresh rows whose key the stored table does not hold."""
    return _join(fresh, stored.select(*keys), keys, "left_anti")


def patch(stored: DataFrame, source: DataFrame, key: str, columns: list[str], load_order: str) -> DataFrame:
    """Overwrite the listed columns that the stored table has; later source rows win, rows without a key patch nothing."""
    columns = [c for c in columns if c in stored.columns]
    named = source.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    last = last_per_key(named.select(key, load_order, *columns), [key], load_order, ties=columns)
    new = last.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns])
    out = _join(stored, new, [key], "left")
    return out.select(*[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in stored.columns])
