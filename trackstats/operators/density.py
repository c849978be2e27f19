"""Kernel densities, histograms and lookups on a density curve.

Every operator first reduces the table to sufficient statistics per grid cell
with a map-side combined aggregation; curves are then built from those cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .keys import lookup
from .ordering import as_of


def tick_step(low: float, high: float, count: int) -> float:
    """Spacing of about ``count`` round ticks (1, 2 or 5 times a power of ten)."""
    raw = (high - low) / count
    power = 10.0 ** math.floor(math.log10(raw))
    error = raw / power
    factor = 10 if error >= math.sqrt(50) else 5 if error >= math.sqrt(10) else 2 if error >= math.sqrt(2) else 1
    return round(factor * power, 12)


def tick_grid(low: float, high: float, count: int) -> tuple[int, int, float]:
    """First and last tick as multiples of the step, and the step."""
    step = tick_step(low, high, count)
    return math.ceil(low / step - 1e-9), math.floor(high / step + 1e-9), step


def _unit(step: float) -> tuple[str, float]:
    """Turn an index into a position without a rounding surprise: divide by 1/step if whole."""
    inverse = round(1 / step)
    return ("/", float(inverse)) if inverse >= 1 and abs(inverse * step - 1) < 1e-9 else ("*", step)


def _at(index: Column, step: float) -> Column:
    op, k = _unit(step)
    return index / k if op == "/" else index * k


def _of(value: Column, step: float) -> Column:
    op, k = _unit(step)
    return value * k if op == "/" else value / k


def _values(df: DataFrame, features: list[str], group: list[str]) -> DataFrame:
    """Long ``(group, feature, v)`` without missing values."""
    cols = df.select(*group, *[F.col(f).cast("double").alias(f) for f in features])
    long = cols.select(*group, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in features])))
    return long.where(S.present("v"))


def density(df: DataFrame, features: list[str], *, h: float, low: float = 0.0, high: float = 1.0,
            ticks: int = 60, group: list[str] = (), bounds: DataFrame | None = None) -> DataFrame:
    """``(group, feature, x, density, n_values)``: Epanechnikov estimate on a tick grid.

    A value reaches only grid points within ``h``, a contiguous index range, and
    the kernel is quadratic there. So the rows of one range are summed up by
    their count and first two moments about the range's centre, and the curve
    follows exactly from those: the table is read once, no row is multiplied by
    the grid, and hot values combine before the shuffle. With ``bounds``
    (``feature, min, max``, one row per feature, as ``feature_stats`` gives them)
    values are normalised first, so that features of any domain share the grid.
    """
    group = list(group)
    first, last, step = tick_grid(low, high, ticks)
    v = F.col("v")
    long = _values(df, features, group)
    if bounds is not None:
        ends = bounds.where(F.col("feature").isin(features)).select("feature", F.col("min").alias("__lo"), F.col("max").alias("__hi"))
        # At most one row per named feature.
        long = long.join(F.broadcast(ends), "feature").withColumn("v", S.min_max("v", F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
    lo = F.greatest(F.ceil(_of(v - h, step)), F.lit(first)).cast("bigint")
    hi = F.least(F.floor(_of(v + h, step)), F.lit(last)).cast("bigint")
    # Values far outside the grid still count as values; they reach no point.
    near = hi >= lo
    long = long.withColumn("lo", F.when(near, lo)).withColumn("hi", F.when(near, hi))
    centre = _at((F.col("lo") + F.col("hi")) / 2, step)
    d = v - centre
    cells = long.groupBy(*group, "feature", "lo", "hi").agg(
        F.count(F.lit(1)).alias("n"), F.sum(d).alias("d1"), F.sum(d * d).alias("d2"))
    # From here on one row per occupied range, about two per grid point. The first
    # of a curve also brings the points that no value reaches.
    curve = Window.partitionBy(*group, "feature")
    cells = cells.withColumns({"n_values": F.sum("n").over(curve), "__no": F.row_number().over(curve.orderBy("lo", "hi"))})
    gap = F.col("x") - centre
    weight = 0.75 / h * (F.col("n") - (F.col("n") * gap * gap - 2 * gap * F.col("d1") + F.col("d2")) / (h * h))
    reached = F.col("i").between(F.col("lo"), F.col("hi"))
    grid = F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))
    own = F.when(F.col("__no") == 1, grid).otherwise(F.sequence("lo", "hi"))
    points = (cells.withColumn("i", F.explode(own)).withColumn("x", _at(F.col("i"), step))
              .groupBy(*group, "feature", "x", "n_values")
              .agg(F.sum(F.when(reached, weight).otherwise(0.0)).alias("w")))
    return points.select(*group, "feature", "x",
                         F.greatest(F.col("w") / F.col("n_values"), F.lit(0.0)).alias("density"), "n_values")


def density_with_total(df: DataFrame, features: list[str], *, group: str, h: float = 0.04,
                       total_label: str = "All Time", **grid) -> DataFrame:
    """Curves per group and for all rows: the total is the groups' mean, weighted by their sizes."""
    curves = density(df, features, h=h, group=[group], **grid)
    rolled = curves.groupBy("feature", "x").agg(
        (F.sum(F.col("density") * F.col("n_values")) / F.sum("n_values")).alias("density"))
    total = rolled.select(F.lit(total_label).alias("period"), "feature", "x", "density")
    return curves.where(F.col(group).isNotNull()).select(
        F.col(group).cast("string").alias("period"), "feature", "x", "density").unionByName(total)


def shared_maximum(curve: DataFrame) -> DataFrame:
    """Highest density over all curves, the common axis limit."""
    return curve.agg(F.max("density").alias("max_density"))


def density_at(rows: DataFrame, curve: DataFrame, feature: str, *, low: float = 0.0, high: float = 1.0,
               ticks: int = 60, group: list[str] = ()) -> DataFrame:
    """Density of each row's value: the next grid point, or the last one beyond the end.

    A grouped ``curve`` is looked up in the row's own group; NULL groups match.
    """
    first, last, step = tick_grid(low, high, ticks)
    points = curve.where(F.col("feature") == feature).select(
        *group, F.round(_of(F.col("x"), step)).cast("bigint").alias("__i"), F.col("x").alias("curve_x"), "density")
    snug = F.ceil(F.round(_of(F.col(feature), step), 9)).cast("bigint")
    index = F.least(F.greatest(snug, F.lit(first).cast("bigint")), F.lit(last).cast("bigint"))
    return lookup(rows.where(S.present(feature)).withColumn("__i", index), points, [*group, "__i"], "inner").drop("__i")


def density_as_of(rows: DataFrame, curve: DataFrame, feature: str, *, group: list[str] = ()) -> DataFrame:
    """Density of each row's value on a curve of any grid: the next point, or the last one beyond the end.

    Rows of groups without a curve are left out; NULL groups match.
    """
    points = curve.where(F.col("feature") == feature).select(*group, F.col("x").alias("curve_x"), "density")
    return as_of(rows, points, feature, at="curve_x", by=list(group))


def histogram(df: DataFrame, feature: str, *, low: float = 0.0, high: float = 1.0, bins: int = 25) -> DataFrame:
    """``(x0, x1, n)`` over round bins; the last bin includes the upper edge."""
    first, last, step = tick_grid(low, high, bins)
    v = F.col(feature)
    index = F.least(F.floor(F.round(_of(v, step), 9)), F.lit(last - 1)).cast("bigint")
    counted = (df.where(S.present(feature) & v.between(low, high)).groupBy(index.alias("i"))
               .agg(F.count(F.lit(1)).alias("n")))
    spine = df.sparkSession.range(first, last).withColumnRenamed("id", "i")
    return spine.join(counted, "i", "left").select(
        _at(F.col("i"), step).alias("x0"), _at(F.col("i") + 1, step).alias("x1"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def histogram_with_mean(df: DataFrame, feature: str, *, low: float = 0.0, high: float = 1.0, bins: int = 25) -> DataFrame:
    """``(x0, x1, n, mean)``: the histogram and, on every bin, the mean of all values, those outside the bins included."""
    first, last, step = tick_grid(low, high, bins)
    v = F.col(feature).cast("double")
    index = F.when(v.between(low, high), F.least(F.floor(F.round(_of(v, step), 9)), F.lit(last - 1)).cast("bigint"))
    counted = df.where(S.present(feature)).groupBy(index.alias("i")).agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("s"))
    # One row per bin, and one for what is outside: rows of both ends meet in a full join.
    every = Window.partitionBy()
    spine = df.sparkSession.range(first, last).withColumnRenamed("id", "i").withColumn("__bin", F.lit(True))
    whole = spine.join(counted, "i", "full").withColumn("mean", F.sum("s").over(every) / F.sum("n").over(every))
    return whole.where("__bin").select(
        _at(F.col("i"), step).alias("x0"), _at(F.col("i") + 1, step).alias("x1"), F.coalesce(F.col("n"), F.lit(0)).alias("n"), "mean")


def density_2d(df: DataFrame, x: str, y: str, *, x_domain: tuple[float, float], y_domain: tuple[float, float],
               cells: int = 40, radius: int = 3) -> DataFrame:
    """``(bx, by, x, y, weight)``: smoothed counts on a ``cells`` by ``cells`` grid.

    Rows are counted per cell first; only occupied cells, at most ``cells**2``,
    are spread over their neighbours with a product of quadratic weights.
    """
    def cell(c: str, domain) -> Column:
        lo, hi = domain
        return F.least(F.floor((F.col(c) - lo) / ((hi - lo) / cells)), F.lit(cells - 1)).cast("int")

    inside = df.where(S.present(x) & S.present(y) & F.col(x).between(*x_domain) & F.col(y).between(*y_domain))
    counted = inside.groupBy(cell(x, x_domain).alias("cx"), cell(y, y_domain).alias("cy")).agg(
        F.count(F.lit(1)).alias("n"))
    offsets = F.sequence(F.lit(-radius), F.lit(radius))
    spread = (counted.withColumn("dx", F.explode(offsets)).withColumn("dy", F.explode(offsets))
              .withColumn("bx", F.col("cx") + F.col("dx")).withColumn("by", F.col("cy") + F.col("dy"))
              .where(F.col("bx").between(0, cells - 1) & F.col("by").between(0, cells - 1)))
    r2 = (radius + 1) ** 2
    # Whole-number weights, so that sums do not depend on the order of rows.
    weight = F.col("n") * (r2 - F.col("dx") * F.col("dx")) * (r2 - F.col("dy") * F.col("dy"))
    out = spread.groupBy("bx", "by").agg(F.sum(weight.cast("bigint")).alias("weight"))

    def centre(b: str, domain) -> Column:
        lo, hi = domain
        return (F.col(b) + 0.5) * ((hi - lo) / cells) + lo

    return out.select("bx", "by", centre("bx", x_domain).alias("x"), centre("by", y_domain).alias("y"), "weight")


def peak(surface: DataFrame) -> DataFrame:
    """The heaviest cell; ties go to the lowest indices."""
    return surface.orderBy(F.col("weight").desc(), "bx", "by").limit(1)


def nearest(df: DataFrame, x: str, y: str, point: DataFrame, *, x_span: float, y_span: float,
            ties: list[str]) -> DataFrame:
    """The row nearest to a one-row ``(x, y)`` point, axes scaled by their spans."""
    at = point.select(F.struct("x", "y")).scalar()  # one subquery for both
    dx, dy = (F.col(x) - at["x"]) / x_span, (F.col(y) - at["y"]) / y_span
    return df.withColumn("distance", dx * dx + dy * dy).orderBy("distance", *ties).limit(1)
