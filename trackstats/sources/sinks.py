"""Writers: CSV, safe replacement behind a name, and batch-wise resumable output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators.keys import membership


def write_csv(df: DataFrame, path: str, *, bom: bool = False) -> None:
    """CSV directory with a header in every file, optionally led by a byte-order mark."""
    if bom:
        df = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    df.write.mode("errorifexists").option("header", True).option("escape", '"').option("quote", '"').csv(path)


def publish(df: DataFrame, name: str, location: str, version: str) -> DataFrame:
    """Write a new version and switch the view ``name`` to it.

    The version lands in its own folder, so a plan may read the old version while
    it is written; readers of the view see the old or the new table, never a mix.
    """
    path = f"{location.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return df.sparkSession.table(name)


def save_batch(df: DataFrame, path: str, batch: int) -> None:
    """Write one batch as its own partition; repeating a failed batch replaces only itself."""
    (df.withColumn("batch", F.lit(batch)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def saved_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All finished batches, an empty table before the first one."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def pending(df: DataFrame, path: str, key: str) -> DataFrame:
    """Rows that no finished batch holds."""
    done = saved_batches(df.sparkSession, path, df.select(key).schema)
    return membership(df, done, [key], present=False)
