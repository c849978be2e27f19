"""Shared building blocks: bounded lookups, skew-safe key joins, top-n, the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = "__key"


def _named_key(keys: list[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias(KEY)


def lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join ``left`` to a ``right`` that holds one row per key; NULL keys match.

    The right side has just been reduced to one row per key and is partitioned
    by it. Joining on a struct of the keys gives both inputs a plain shuffle of
    their own, which is the shape AQE needs to split a hot key of the left side
    over many tasks. The right side of such a join is one small row per key.
    """
    probe = right.select(_named_key(keys), *[c for c in right.columns if c not in keys])
    return left.select("*", _named_key(keys)).join(probe, KEY, how).drop(KEY)


def membership(left: DataFrame, right: DataFrame, keys: list[str], *, present: bool) -> DataFrame:
    """Rows of ``left`` whose key does (or does not) occur in ``right``."""
    return lookup(left, right.select(*keys).distinct(), keys, "left_semi" if present else "left_anti")


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that are computed once however often they are used.

    A generator keeps the optimizer from copying the expressions into every
    filter and projection that mentions them.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, *,
          rank: str | None = None, salt_by: list[str] | None = None, salts: int | None = None) -> DataFrame:
    """First ``n`` rows of every group in a total order.

    Each map task keeps at most ``n`` rows per group before the shuffle, so an
    aggregated input sends ``n`` rows per reduce partition and group. A raw input
    has far more tasks: ``salt_by`` then ranks a group in ``salts`` independent
    slices first, as many as there are shuffle partitions, and the task that
    settles it sees ``n * salts`` rows. Beyond an ``n`` of Spark's
    ``spark.sql.optimizer.windowGroupLimitThreshold`` rows are not cut before
    the shuffle; the slices still spread a hot group over all tasks.
    """
    pos = rank or "__pos"
    if salt_by:
        salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slice_no = F.pmod(F.xxhash64(*salt_by), F.lit(salts))
        w = Window.partitionBy(*group, "__slice").orderBy(*order)
        df = (df.withColumn("__slice", slice_no)
              .withColumn("__pos", F.row_number().over(w)).where(F.col("__pos") <= n)
              .drop("__slice", "__pos"))
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(pos, F.row_number().over(w)).where(F.col(pos) <= n)
    return out if rank else out.drop(pos)


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in a total order; NULL keys are equal."""
    return top_n(df, keys, order, 1)


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a scratch folder; a cluster session without
    one is an error, since a machine-local folder would not survive an executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: for what is read several times and costly to make."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
