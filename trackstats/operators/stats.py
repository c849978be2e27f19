"""Feature bounds and means, yearly trends, correlation, summaries, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab


def _number(feature: str) -> Column:
    """The feature as a double with NaN read as missing."""
    return F.nullif(F.col(feature).cast("double"), F.lit(float("nan")))


def _long(row: DataFrame, ids: list[str], features: list[str], measures: list[str]) -> DataFrame:
    """Turn ``<measure>__<feature>`` columns into one row per feature."""
    structs = F.array(*[
        F.struct(F.lit(f).alias("feature"), *[F.col(f"{m}__{f}").alias(m) for m in measures])
        for f in features])
    return row.select(*ids, F.inline(structs))


def feature_stats(all_rows: DataFrame, selected: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, min, max, mean)``: bounds over all rows, mean over the selection.

    One pass over each input for all features; the result has one row per feature.
    """
    bounds, means = [], []
    for f in features:
        low, high, default = vocab.FEATURE_BOUNDS.get(f, vocab.OPEN_BOUNDS)
        found_low = F.coalesce(F.min(_number(f)), F.lit(0.0))
        found_high = F.coalesce(F.nullif(F.max(_number(f)), F.lit(0.0)), F.lit(default))
        bounds.append((F.lit(low) if low is not None else found_low).alias(f"min__{f}"))
        bounds.append((F.lit(high) if high is not None else found_high).alias(f"max__{f}"))
        means.append(F.coalesce(F.avg(_number(f)), F.lit(0.0)).alias(f"mean__{f}"))
    b = _long(all_rows.agg(*bounds), [], features, ["min", "max"])
    m = _long(selected.agg(*means), [], features, ["mean"])
    return b.join(F.broadcast(m), "feature")  # one row per feature on both sides


def dense_years(yearly: DataFrame, values: list[str], year: str = "Year") -> DataFrame:
    """Add every missing year between the first and the last, its values 0.

    Works on a table with one row per year: each row also produces the empty
    years before the next one, so the table is read once.
    """
    following = F.lead(year).over(Window.orderBy(year))  # one row per year
    last = F.coalesce(following - 1, F.col(year)).cast(dict(yearly.dtypes)[year])
    spread = (yearly.where(F.col(year).isNotNull()).withColumn("__last", last)
              .withColumn("__y", F.explode(F.sequence(F.col(year), F.col("__last")))))
    filled = [F.when(F.col("__y") == F.col(year), F.coalesce(F.col(v), F.lit(0))).otherwise(F.lit(0))
              .cast(dict(yearly.dtypes)[v]).alias(v) for v in values]
    return spread.select(F.col("__y").alias(year), *filled)


def yearly_means(df: DataFrame, features: list[str], year: str = "Year") -> DataFrame:
    """Mean of every feature per year, every year of the range present."""
    means = df.groupBy(year).agg(*[F.avg(_number(f)).alias(f) for f in features])
    return dense_years(means, features, year)


def means_with_total(df: DataFrame, features: list[str], year: str = "Year",
                     total_label: str = "All Time") -> DataFrame:
    """Per-year and all-time count and means.

    The rows are aggregated once per year; the total row combines those sums, so
    no row of the table is expanded for the grouping set.
    """
    partial = df.groupBy(year).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(_number(f)).alias(f"s__{f}") for f in features],
        *[F.count(_number(f)).alias(f"c__{f}") for f in features])
    rolled = partial.rollup(year).agg(
        F.grouping(year).alias("__total"), F.sum("n").alias("n"),
        *[F.try_divide(F.sum(f"s__{f}"), F.sum(f"c__{f}")).alias(f"mean_{f}") for f in features])
    label = F.when(F.col("__total") == 1, F.lit(total_label)).otherwise(F.col(year).cast("string"))
    return rolled.select(label.alias("period"), "n", *[f"mean_{f}" for f in features])


def selection_summary(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows with both features present, and the two means."""
    return df.where(S.present(x) & S.present(y)).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.avg(x), F.lit(0.0)).alias("mean_x"),
        F.coalesce(F.avg(y), F.lit(0.0)).alias("mean_y"))


def correlation(df: DataFrame, features: list[str]) -> DataFrame:
    """``(feature_x, feature_y, n, r)`` for all pairs, pairwise-complete.

    Rows are summed per pattern of missing values: within a pattern the same
    features are present in every row, so one sum per feature and one per pair
    are enough. Patterns are few, and each pair then adds up the patterns that
    hold both features. Values are centred on the means of a first pass to keep
    the products small. A column that is constant over a pair's rows has no
    correlation: NULL, never an error.
    """
    features = [f for f in features if f in df.columns]
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cols = df.select(*[_number(f).alias(f) for f in features])
    means = cols.agg(F.struct(*[F.avg(f).alias(f) for f in features])).scalar()
    centred = [F.coalesce(F.col(f) - means[f], F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)]
    pattern = sum((F.col(f).isNotNull().cast("bigint") * (1 << i) for i, f in enumerate(features)), F.lit(0))
    rows = cols.select(pattern.alias("pattern"), *centred)
    x = [F.col(f"x{i}") for i in range(k)]
    sums = rows.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(v) for v in x]).alias("s"), F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"),
        F.array(*[F.min(v) for v in x]).alias("low"), F.array(*[F.max(v) for v in x]).alias("high"))
    at = {pair: q for q, pair in enumerate(pairs)}
    members = F.array(*[
        F.struct(F.lit(features[i]).alias("a"), F.lit(features[j]).alias("b"),
                 F.lit((1 << i) | (1 << j)).cast("bigint").alias("bits"),
                 *[F.lit(v).alias(n) for n, v in (("i", i), ("j", j), ("ij", at[i, j]), ("ii", at[i, i]), ("jj", at[j, j]))])
        for i, j in pairs])

    def part(array: str, index: str) -> Column:
        return F.get(array, F.col(index))

    per = (sums.select("*", F.inline(members)).where(F.col("pattern").bitwiseAND(F.col("bits")) == F.col("bits"))
           .groupBy("a", "b").agg(
               F.sum("n").alias("n"), F.sum(part("s", "i")).alias("si"), F.sum(part("s", "j")).alias("sj"),
               F.sum(part("p", "ij")).alias("pij"), F.sum(part("p", "ii")).alias("pii"), F.sum(part("p", "jj")).alias("pjj"),
               (F.max(part("high", "i")) > F.min(part("low", "i"))).alias("vary_i"),
               (F.max(part("high", "j")) > F.min(part("low", "j"))).alias("vary_j")))
    n = F.col("n")
    cov = F.col("pij") - F.col("si") * F.col("sj") / n
    var_i, var_j = F.col("pii") - F.col("si") * F.col("si") / n, F.col("pjj") - F.col("sj") * F.col("sj") / n
    r = F.when(F.col("vary_i") & F.col("vary_j"), F.try_divide(cov, F.sqrt(var_i * var_j)))
    r = F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)
    both = F.array(F.struct(F.col("a").alias("feature_x"), F.col("b").alias("feature_y")),
                   F.struct(F.col("b").alias("feature_x"), F.col("a").alias("feature_y")))
    return per.select(F.inline(F.when(F.col("a") == F.col("b"), F.slice(both, 1, 1)).otherwise(both)), "n", r.alias("r"))


def quadrant_counts(df: DataFrame, x: str, y: str) -> DataFrame:
    return (df.select(S.quadrant(x, y).alias("quadrant")).where(F.col("quadrant").isNotNull())
            .groupBy("quadrant").agg(F.count(F.lit(1)).alias("n")))


def profile(rows: DataFrame, stats: DataFrame, features: list[str], label: str) -> DataFrame:
    """``(label, axis, value, originalValue)`` of each row, value normalised."""
    long = rows.select(label, *[_number(f).alias(f) for f in features]).unpivot(
        [label], features, "axis", "originalValue")
    # One statistics row per feature: the broadcast is bounded by the feature list.
    s = F.broadcast(stats.select(F.col("feature").alias("axis"), "min", "max"))
    return long.join(s, "axis").select(
        label, "axis", S.min_max("originalValue", F.col("min"), F.col("max")).alias("value"), "originalValue")


def mean_profile(stats: DataFrame, label: str, name: str = "average") -> DataFrame:
    return stats.select(
        F.lit(name).alias(label), F.col("feature").alias("axis"),
        S.min_max("mean", F.col("min"), F.col("max")).alias("value"), F.col("mean").alias("originalValue"))


def encode_marks(df: DataFrame, size: str, color: str, all_rows: DataFrame, *,
                 size_range: tuple[float, float] = (2.0, 22.0)) -> DataFrame:
    """Mark size and colour position of every row, on the domain of the whole table."""
    from .select import feature_bounds
    (low, high), (s_low, s_high) = feature_bounds(all_rows, [color, size], {"Streams": (0.0, None, 1.0)})
    return df.withColumn("mark_size", S.sqrt_scale(size, s_low, s_high, *size_range)).withColumn(
        "mark_color", S.linear_scale(color, low, high))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(column).asc_nulls_last()))


def distinct_range(df: DataFrame, column: str) -> DataFrame:
    """One row: number of distinct values, smallest, largest."""
    return (df.groupBy(column).agg(F.lit(1).alias("one"))
            .agg(F.count(column).alias("n_values"), F.min(column).alias("first_value"),
                 F.max(column).alias("last_value")))
