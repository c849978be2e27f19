"""Cleaning: required values, duplicates, keep-best, top rows per year, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab
from .keys import best_per_key, stored, top_n
from .ordering import By, top_n_by_ranges

#: Spark cuts groups before a shuffle up to so many rows (``spark.sql.optimizer.windowGroupLimitThreshold``).
LARGE_N = 1000


def drop_missing(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows with a value in every required column; NaN counts as missing."""
    return df.na.drop("any", subset=required)


def distinct_rows(df: DataFrame, *, derived: dict[str, Column] | None = None) -> DataFrame:
    """Every different row once; ``derived`` columns follow from the others and are made again instead of being moved."""
    again = derived or {}
    return df.drop(*again).dropDuplicates().withColumns(again).select(*df.columns)


def coerce_measure(df: DataFrame, column: str, default: float = 0.0) -> DataFrame:
    """Number from text; what does not parse becomes the default."""
    return df.withColumn(column, S.coerce_number(column, default))


def keep_best(df: DataFrame, keys: list[str], measure: str, ties: list[Column]) -> DataFrame:
    """One row per key with the highest measure."""
    return best_per_key(df, keys, [F.col(measure).desc_nulls_last(), *ties])


def drop_columns(df: DataFrame, columns: list[str] = vocab.DROPPED_COLUMNS) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*columns)


def available(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def project_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*available(df, wanted))


def top_per_year(df: DataFrame, n: int, *, year: str = "Year", measure: str = "Streams",
                 ties: list[str]) -> DataFrame:
    """Highest ``n`` rows of every year; rows without a year belong to none.

    Up to ``LARGE_N`` rows a task keeps its own first ``n`` before they meet; a larger ``n`` is settled by ranges of the order,
    which reads the table several times: it is stored first, when this is called.
    """
    order = [By(measure, descending=True, nulls_last=True), *[By(t, nulls_last=True) for t in ties]]
    dated = df.where(F.col(year).isNotNull())
    if n > LARGE_N:
        return top_n_by_ranges(stored(dated), [year], order, n)
    return top_n(dated, [year], [o.sort() for o in order], n, salt_by=ties)


def sort_catalogue(df: DataFrame, *, year: str = "Year", measure: str = "Streams",
                   ties: list[str]) -> DataFrame:
    return df.orderBy(F.col(year).asc_nulls_last(), F.col(measure).desc_nulls_last(), *ties)


def preview(df: DataFrame, order: list[Column | str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def quality_report(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``(check, column, n)``: missing values per column, duplicate rows, duplicate keys.

    A row moves as two 64-bit hashes of its values, two of its key and the bits
    of its missing columns, whatever its width; equal rows are counted before
    they move, and all checks come from that one table.
    """
    columns = df.columns
    with_keys = bool(keys) and all(k in columns for k in keys)
    gone = [F.col(c).isNull() | F.isnan(c) if t in ("double", "float") else F.col(c).isNull() for c, t in df.dtypes]
    words = [sum(F.shiftleft(g.cast("long"), j) for j, g in enumerate(gone[i:i + 62])).alias(f"__gone{i // 62}") for i in range(0, len(gone), 62)]
    parts = [*words, *_row_hashes(columns, "__row"), *(_row_hashes(keys, "__key") if with_keys else [])]
    narrow = df.select(*parts)
    per = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("__n"))
    bit = [F.shiftright(f"__gone{i // 62}", i % 62).bitwiseAND(F.lit(1)) for i in range(len(columns))]
    missing = per.agg(*[F.coalesce(F.sum(b * F.col("__n")), F.lit(0)) for b in bit])
    missing = missing.toDF(*columns).unpivot([], columns, "column", "n").select(
        F.lit("missing").alias("check"), "column", "n")
    report = missing.unionByName(_surplus(per, "duplicate_rows"))
    if with_keys:
        report = report.unionByName(_surplus(per.groupBy("__key0", "__key1").agg(F.sum("__n").alias("__n")), "duplicate_keys"))
    return report


def _row_hashes(columns: list[str], name: str) -> list[Column]:
    """Two hashes of a row, 128 bits together; a missing value counts with its place."""
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*values).alias(f"{name}0"), F.xxhash64(F.lit(name), *values).alias(f"{name}1")]


#: Types whose text tells apart what is different.
_SPELLED = ("string", "boolean", "date", "tinyint", "smallint", "int", "bigint", "float", "double")


def _narrow(df: DataFrame) -> list[Column]:
    """What equal rows have in common: a SHA-256 of their values, whatever their width, beside the columns it cannot hold."""
    def spelled(c: str, t: str) -> Column:
        value = (F.col(c) + F.lit(0.0) if t in ("float", "double") else F.col(c)).cast("string")  # -0.0 equals 0.0
        return F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("-"))
    parts = [spelled(c, t) for c, t in df.dtypes if t in _SPELLED]
    return [F.unhex(F.sha2(F.concat(*parts, F.lit("")).cast("binary"), 256)).alias("__row"), *[F.col(c) for c, t in df.dtypes if t not in _SPELLED]]


def _surplus(counted: DataFrame, check: str) -> DataFrame:
    """Rows beyond the first of each key, from counts per key."""
    return (counted.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("n"))
            .select(F.lit(check).alias("check"), F.lit(None).cast("string").alias("column"), "n"))


def distinct_count(df: DataFrame) -> DataFrame:
    """One row: the number of different rows, without moving long texts."""
    return df.select(*_narrow(df)).distinct().agg(F.count(F.lit(1)).alias("rows_out"))


def loading_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """One row ``(loaded, missing, copies)``: all rows, complete ones and different complete ones, in one pass.

    A complete row moves as its digest; incomplete ones are counted before they move.
    """
    types, complete = dict(df.dtypes), F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            complete = complete & ~F.isnan(c)
    names = [f"__d{i}" for i in range(len(_narrow(df)))]
    narrow = df.select(complete.alias("__complete"), *[F.when(complete, d).alias(n) for n, d in zip(names, _narrow(df), strict=True)])
    per = narrow.groupBy("__complete", *names).agg(F.count(F.lit(1)).alias("__n"))
    whole = F.when(F.col("__complete"), F.col("__n"))
    return per.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("loaded"), F.coalesce(F.sum(whole), F.lit(0)).alias("missing"), F.count(whole).alias("copies"))


def counted(df: DataFrame, by: str) -> DataFrame:
    """One row: the number of rows, summed over the groups of a column.

    A count that reads the column needs what the step after it needs, so Spark makes the table once for both.
    """
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("__n")).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_out"))


def funnel(steps: list[tuple[str | list[str], DataFrame]]) -> DataFrame:
    """``(step_no, step, rows_out, removed)`` of successive stages of a job.

    A stage is a table, or a one-row table that already holds ``rows_out``.
    Several stages may share a one-row table that has a column for each of their names.
    """
    counts, i = None, 0
    for name, df in steps:
        names = name if isinstance(name, list) else [name]
        if isinstance(name, str):
            df = (df if df.columns == ["rows_out"] else df.agg(F.count(F.lit(1)).alias("rows_out"))).withColumnRenamed("rows_out", name)
        rows = [F.struct(F.lit(i + j).alias("step_no"), F.lit(n).alias("step"), F.col(f"`{n}`").alias("rows_out")) for j, n in enumerate(names)]
        row = df.select(F.inline(F.array(*rows)))
        counts = row if counts is None else counts.unionByName(row)
        i += len(names)
    before = F.lag("rows_out").over(Window.orderBy("step_no"))  # one row per step
    return counts.withColumn("removed", F.coalesce(before - F.col("rows_out"), F.lit(0)))
