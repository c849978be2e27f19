"""Intermediate tables in the shared folder that the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.keys import scratch_path


def stored(df: DataFrame, name: str = "step", *, narrow: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: a lost executor costs no recomputation.

    A ``narrow`` table has a few short columns; it is written as two files per
    core of the cluster rather than one per shuffle partition.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark)}/{name}"
    (df.coalesce(2 * spark.sparkContext.defaultParallelism) if narrow else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
