"""Scans in a total order that no single task carries out: row numbers, running sums, large top-n, as-of lookups.

Rows are dealt into ranges of the order. The ranges' bounds are quantiles of a
sample that the order's own values choose by their hash, so a retried task finds
the same bounds and nothing has to be written in between. A range is sorted in one
task; what the ranges before it add is a table of one row per range. The input is
read once for the number of rows, once for the sample, once for the ranges' sums
and once for the result, each time only the columns needed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import lookup

#: Sampled values for each range.
SAMPLED = 16
RANGE = "__range"


@dataclass(frozen=True)
class By:
    """A column of an order: ascending with missing values first unless said otherwise."""

    column: str
    descending: bool = False
    nulls_last: bool = False

    def sort(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()


Order = list[By | str]


def _order(order: Order) -> list[By]:
    return [By(o) if isinstance(o, str) else o for o in order]


def _compare(a: Column, b: Column, order: list[By]) -> Column:
    """-1, 0 or 1 for two structs with the fields ``o0, o1, ...``."""
    out = F.lit(0)
    for i, by in reversed(list(enumerate(order))):
        x, y = a[f"o{i}"], b[f"o{i}"]
        up, null = (1, -1) if by.descending else (-1, 1), 1 if by.nulls_last else -1
        # Missing values compare as neither, so the cheap and frequent cases come first.
        out = (F.when(x.eqNullSafe(y), out).when(x < y, F.lit(up[0])).when(x > y, F.lit(up[1]))
               .when(x.isNull(), F.lit(null)).otherwise(F.lit(-null)))
    return out


def _bounds(df: DataFrame, order: list[By], ranges: int) -> DataFrame:
    """``(__run, __bounds)``: at most ``ranges - 1`` ascending bounds in runs of about the square root of their number."""
    keys = df.select(*[F.col(by.column).alias(f"o{i}") for i, by in enumerate(order)])
    space = 1 << 40
    count = keys.agg(F.count(F.lit(1)).alias("n")).scalar()
    place = F.pmod(F.xxhash64(F.lit(17), *keys.columns), F.lit(space))
    chosen = keys.where(place <= F.lit(float(SAMPLED * ranges)) * float(space) / F.greatest(count, F.lit(1)))
    values = F.array_sort(F.collect_set(F.struct(*keys.columns)), lambda a, b: _compare(a, b, order))  # about SAMPLED * ranges
    run = max(1, math.isqrt(ranges))
    at = F.transform(F.sequence(F.lit(1), F.lit(max(1, ranges - 1))), lambda i: F.floor(i * F.size("v") / ranges).cast("int"))
    some = F.filter(F.array_distinct(at), lambda i: (i >= 1) & (i < F.size("v"))) if ranges > 1 else F.array().cast("array<int>")
    picked = chosen.agg(values.alias("v")).select(F.transform(some, lambda i: F.get("v", i)).alias("b")).where(F.size("b") > 0)
    runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size("b") / run).cast("int") - 1), lambda i: F.slice("b", i * run + 1, F.lit(run)))
    return picked.select(F.posexplode(runs).alias("__run", "__bounds"))


def with_range(df: DataFrame, order: Order, *, ranges: int | None = None) -> DataFrame:
    """Add the number of each row's range; ranges are ascending in the order and about equally large.

    Rows that are alike in the whole order share a range, so the order should tell rows apart.
    A row meets the first bound of every run, and then the bounds of its own run.
    """
    order = _order(order)
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(df, order, ranges)
    heads = bounds.agg(F.transform(F.array_sort(F.collect_list(F.struct("__run", F.get("__bounds", F.lit(0)).alias("head")))), lambda x: x["head"]).alias("h")).scalar()
    own = F.struct(*[F.col(by.column).alias(f"o{i}") for i, by in enumerate(order)])

    def reached(values: str) -> Column:
        return F.size(F.filter(values, lambda b: _compare(b, F.col("__own"), order) <= 0))
    made = df.withColumn("__own", own).withColumn("__heads", heads).withColumn("__run", reached("__heads") - 1).drop("__heads")
    # The square root of the number of ranges: the broadcast is bounded by the number of partitions.
    made = made.join(F.broadcast(bounds), "__run", "left")
    within = F.when(F.col("__bounds").isNotNull(), reached("__bounds")).otherwise(0)
    width = max(1, math.isqrt(ranges)) + 1
    return made.withColumn(RANGE, (F.col("__run") + 1) * width + within).drop("__own", "__run", "__bounds")


def _sorted(order: Order) -> list[Column]:
    return [by.sort() for by in _order(order)]


def _before(sums: DataFrame, columns: list[str], group: list[str] = ()) -> DataFrame:
    """For each range the sums of the ranges before it (of its group): one row per range and group."""
    w = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, RANGE, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(c) for c in columns])


def with_row_index(df: DataFrame, order: Order, name: str = "row_index", *, ranges: int | None = None) -> DataFrame:
    """Number rows 0..n-1 in a total order; nothing runs or is written before the result is asked for."""
    ranged = with_range(df, order, ranges=ranges)
    before = _before(ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("__n")), ["__n"])
    local = F.row_number().over(Window.partitionBy(RANGE).orderBy(*_sorted(order))) - 1
    # One row per range: the broadcast cannot grow with the data.
    return (ranged.withColumn("__local", local).join(F.broadcast(before), RANGE)
            .withColumn(name, F.col("__n") + F.col("__local")).drop(RANGE, "__local", "__n"))


def with_running_sum(df: DataFrame, order: Order, value: str, name: str, *, ranges: int | None = None) -> DataFrame:
    """Add the sum of ``value`` over this row and all before it; missing values count as 0."""
    ranged = with_range(df, order, ranges=ranges)
    v = F.coalesce(F.col(value), F.lit(0))
    before = _before(ranged.groupBy(RANGE).agg(F.sum(v).alias("__s")), ["__s"])
    own = F.sum(v).over(Window.partitionBy(RANGE).orderBy(*_sorted(order)).rowsBetween(Window.unboundedPreceding, 0))
    return (ranged.withColumn("__own", own).join(F.broadcast(before), RANGE)
            .withColumn(name, F.col("__s") + F.col("__own")).drop(RANGE, "__own", "__s"))


def top_n_by_ranges(df: DataFrame, group: list[str], order: Order, n: int, *, rank: str | None = None, ranges: int | None = None) -> DataFrame:
    """The first ``n`` rows of every group, however large ``n`` is.

    Rows are counted per group and range. Ranges that begin after a group's n-th
    row are left out before anything is sorted, and the others are ranked one by one.
    """
    pos = rank or "__pos"
    ranged = with_range(df, [*group, *order], ranges=ranges)
    before = _before(ranged.groupBy(*group, RANGE).agg(F.count(F.lit(1)).alias("__n")), ["__n"], group).where(F.col("__n") < n)
    kept = lookup(ranged, before, [*group, RANGE], "inner")
    local = F.row_number().over(Window.partitionBy(*group, RANGE).orderBy(*_sorted(order)))
    out = kept.withColumn(pos, (F.col("__n") + local).cast("int")).where(F.col(pos) <= n).drop(RANGE, "__n")
    return out if rank else out.drop(pos)


def as_of(rows: DataFrame, points: DataFrame, on: str, *, at: str, by: list[str] = (), ranges: int | None = None) -> DataFrame:
    """Each row with the columns of the first point not below its value, or of the last point if it lies beyond all.

    ``points`` has one row per (``by``, ``at``) on any grid; NULL groups match.
    Rows without a value and rows of groups without a point are left out. Only
    different values take part in the scan, so a value that is frequent is no
    larger than any other; a point is carried backwards over the borders of ranges.
    """
    by, given = list(by), [c for c in points.columns if c not in (*by, at)]
    key = F.col(on).cast("double")
    point = F.struct(F.col(at).cast("double").alias("at"), *given)
    asked = rows.where(key.isNotNull() & ~F.isnan(key)).select(*by, key.alias("__v")).distinct().select(
        *by, "__v", F.lit(0).alias("__side"), F.lit(None).cast(points.select(point.alias("p")).schema["p"].dataType).alias("__p"))
    held = points.select(*by, F.col(at).cast("double").alias("__v"), F.lit(1).alias("__side"), point.alias("__p"))
    both = with_range(asked.unionByName(held), [*by, "__v", "__side"], ranges=ranges)
    first = both.where("__side = 1").groupBy(*by, RANGE).agg(F.min_by("__p", "__v").alias("__head"), F.max_by("__p", "__v").alias("__tail"))
    # One row per range and group: the next range's first point, and the group's last one.
    known = both.select(*by, RANGE).distinct()
    following = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = lookup(known, first, [*by, RANGE], "left").select(
        *by, RANGE, F.first("__head", ignorenulls=True).over(following).alias("__next"), F.last("__tail", ignorenulls=True).over(whole).alias("__last"))
    here = Window.partitionBy(*by, RANGE).orderBy("__v", "__side").rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("__here", F.first("__p", ignorenulls=True).over(here)).where("__side = 0")
    answers = (lookup(found, carried, [*by, RANGE], "left").select(*by, "__v", F.coalesce("__here", "__next", "__last").alias("__p"))
               .where("__p is not null"))
    return (lookup(rows.withColumn("__v", key), answers, [*by, "__v"], "inner")
            .select(*rows.columns, F.col("__p.at").alias(at), *[F.col(f"__p.{c}") for c in given]))
