"""CSV readers with the tolerance of the catalogue's files, and typed loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions import vocab
from .records import csv_records

OVERFLOW = "__overflow"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names; only the head of one file is read. A byte-order mark is ignored."""
    return [c.lstrip("﻿") for c in spark.read.csv(path, header=True, escape='"').columns]


def _text_columns(spark: SparkSession, path: str, names: list[str], one_line: bool) -> DataFrame:
    """The fields of all records as text."""
    if one_line:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        return spark.read.schema(schema).csv(path, header=True, escape='"', enforceSchema=True)
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
    return csv_records(spark, path).select(F.from_csv("record", ddl, {"escape": '"'}).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None, *,
             one_line: bool = False, missing: list[str] = vocab.MISSING_TEXT) -> DataFrame:
    """CSV with a header: rows with too many fields are skipped, short ones padded with NULL.

    Text that stands for a missing value becomes NULL, and so does what does not
    parse as the declared type. Files are split over tasks, and quoted fields may
    hold line ends; ``one_line`` saves a scan where every record is known to be one line.
    """
    names = csv_header(spark, path)
    raw = _text_columns(spark, path, [*names, OVERFLOW], one_line)
    raw = raw.where(F.col(f"`{OVERFLOW}`").isNull()).drop(OVERFLOW)
    types = types or {}
    out = []
    for c in names:
        text = F.col(f"`{c}`")
        value = F.when(~text.isin(missing), text)
        wanted = types.get(c, "string")
        if wanted in ("double", "float"):
            value = F.nullif(value.try_cast(wanted), F.lit(float("nan")).cast(wanted))
        elif wanted != "string":
            value = value.try_cast(wanted)
        out.append(value.alias(c))
    return raw.select(*out)


def read_ragged_csv(spark: SparkSession, path: str, column: str, *, one_line: bool = False) -> tuple[DataFrame, str]:
    """CSV whose short rows are padded with empty text, with a named column added if absent.

    Returns the table and the column's name as spelled in the header; the name is
    looked up ignoring case. Empty lines are skipped by the reader.
    """
    names = csv_header(spark, path)
    raw = _text_columns(spark, path, names, one_line)
    df = raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names])
    spelled = next((c for c in names if c.lower() == column.lower()), None)
    if spelled is None:
        return df.withColumn(column, F.lit("")), column
    return df, spelled


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Remove index columns that an earlier writer left behind."""
    return df.drop("Unnamed: 0", "_c0")


def typed_catalogue(df: DataFrame, features: list[str]) -> DataFrame:
    """Numbers from text with the dashboard's defaults.

    Streams 0, year 2024, features 0 when not a number; key and mode stay
    missing. A feature that only starts like a number is missing, not 0.
    """
    def feature(c: str):
        return F.when(S.prefix_float(c).isNull(), F.lit(0.0)).otherwise(S.whole_float(c))

    changes = {
        "Streams": F.coalesce(S.prefix_float("Streams"), F.lit(0.0)),
        "Year": F.coalesce(F.nullif(S.prefix_int("Year"), F.lit(0)), F.lit(vocab.DEFAULT_YEAR)).cast("int"),
        "key": S.prefix_int("key").cast("int"),
        "mode": S.prefix_int("mode").cast("int"),
        **{f: feature(f) for f in features},
    }
    present = {c: v for c, v in changes.items() if c in df.columns}
    if "duration_ms" in df.columns:
        present["duration_min"] = S.minutes(F.coalesce(S.prefix_float("duration_ms"), F.lit(0.0)))
    return df.withColumns(present)


def typed_words(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "Year": F.coalesce(S.prefix_int("Year"), F.lit(0)).cast("int"),
        "Frequency": F.coalesce(S.prefix_int("Frequency"), F.lit(0))})
