"""Category-by-year tables, stacked layers and their labels, key rings, events.

Wide scans end in one aggregation per table; the window functions below it run
on (year, series) totals, whose size is the number of years times series.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab
from .keys import lookup
from .ordering import with_running_sum


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of constants, built inside the plan."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


# --- counts and shares ---------------------------------------------------------

def two_key_counts(df: DataFrame, a: str = "key", b: str = "mode") -> DataFrame:
    return df.where(S.present(a) & S.present(b)).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def key_ring(df: DataFrame, key: str = "key", mode: str = "mode") -> DataFrame:
    """24 slots in circle-of-fifths order, major outside and relative minor inside."""
    slots = []
    for i, k in enumerate(vocab.CIRCLE_OF_FIFTHS):
        minor = (k + 9) % 12
        slots.append((i, k, 1, vocab.KEY_NAMES[k]))
        slots.append((i, minor, 0, vocab.KEY_NAMES[minor] + "m"))
    spine = literal_table(df.sparkSession, slots, ["ring_order", "key", "mode", "label"])
    counts = two_key_counts(df, key, mode).select(
        F.col(key).cast("int").alias("key"), F.col(mode).cast("int").alias("mode"), "n")
    return spine.join(counts, ["key", "mode"], "left").select(
        "ring_order", "key", "mode", "label", F.coalesce("n", F.lit(0)).alias("n"))


def category_by_year(words: DataFrame, categories: list[str] | None = None, *, year: str = "Year",
                     category: str = "Category", value: str = "Frequency") -> DataFrame:
    """One row per year, one column per category, 0 where a category is absent."""
    wanted = [c for c in vocab.CATEGORIES if c != "Other"] if categories is None else categories
    return words.groupBy(year).pivot(category, wanted).agg(F.sum(value)).na.fill(0, subset=wanted)


def share_by_year(df: DataFrame, labels: list[str] = vocab.SHARE_TOPICS, *, year: str = "Year",
                  label: str = "Topic", other: str = "Other") -> DataFrame:
    """Percent of each year's rows per label; everything else, NULL included, is ``other``."""
    total = F.count(F.lit(1))
    named = F.coalesce(F.col(label).isin(labels), F.lit(False))
    return df.groupBy(year).agg(
        *[(F.count_if(F.col(label) == v) / total * 100).alias(v) for v in labels],
        (F.count_if(~named) / total * 100).alias(other))


def melt(wide: DataFrame, id_column: str, series: list[str], *, name: str = "series",
         value: str = "value") -> DataFrame:
    """Wide to long, numbering the series in the given order."""
    structs = [F.struct(F.lit(i).alias("series_no"), F.lit(s).alias(name), F.col(s).alias(value))
               for i, s in enumerate(series)]
    return wide.select(id_column, F.inline(F.array(*structs)))


def category_totals(words: DataFrame, *, category: str = "Category", value: str = "Frequency",
                    default: str = "other", hidden: str = "Other") -> DataFrame:
    """``(category, value, percent)``, largest first.

    A missing category becomes ``default``, which is not the hidden one.
    """
    key = F.coalesce(F.nullif(F.col(category), F.lit("")), F.lit(default))
    summed = words.groupBy(key.alias("category")).agg(F.sum(value).alias("value"))
    shown = summed.where((F.col("value") > 0) & (F.col("category") != hidden))
    total = F.sum("value").over(Window.partitionBy())  # one row per category
    return shown.withColumn("percent", F.col("value") * 100.0 / total).orderBy(F.col("value").desc(), "category")


# --- stacked layers -------------------------------------------------------------

def stack_layers(long: DataFrame, *, year: str = "Year", order: str = "series_no", value: str = "value",
                 offset: str = "none") -> DataFrame:
    """Lower and upper edge of every series in its year, from zero or from the wiggle baseline."""
    w = Window.partitionBy(year).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    top = F.sum(value).over(w)
    if offset == "none":
        return long.withColumn("y1", top).withColumn("y0", F.col("y1") - F.col(value))
    moved = with_wiggle(long, year=year, order=order, value=value).withColumn("y1", top + F.col("baseline"))
    return moved.withColumn("y0", F.col("y1") - F.col(value)).drop("baseline")


def with_wiggle(long: DataFrame, *, year: str = "Year", order: str = "series_no",
                value: str = "value") -> DataFrame:
    """Add the ``baseline`` that minimises the weighted slope of the layers (Byron & Wattenberg 2008).

    Windows within a year and within a series give each year's step; the steps,
    one per year, are added up by ranges of years, so no task sees all years.
    """
    in_year = Window.partitionBy(year)
    ordered = in_year.orderBy(order)
    below = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rise = F.col(value) - F.lag(value).over(Window.partitionBy(order).orderBy(year))
    slope = F.col("__rise") / 2.0 + F.coalesce(F.sum("__rise").over(below), F.lit(0))
    ratio = F.try_divide(-F.sum(F.col("__slope") * F.col(value)).over(in_year), F.sum(value).over(in_year))
    step = F.when(F.col("__first") == 1, F.coalesce(ratio, F.lit(0.0))).otherwise(0.0)
    steps = (long.withColumn("__rise", rise).withColumn("__slope", slope).withColumn("__first", F.row_number().over(ordered))
             .withColumn("__step", step).groupBy(year).agg(F.sum("__step").alias("__step")))
    return lookup(long, with_running_sum(steps, [year], "__step", "baseline").drop("__step"), [year], "left")


def wiggle_baseline(long: DataFrame, *, year: str = "Year", order: str = "series_no",
                    value: str = "value") -> DataFrame:
    """``(year, baseline)``, one row per year."""
    return with_wiggle(long, year=year, order=order, value=value).groupBy(year).agg(F.first("baseline").alias("baseline"))


def inside_out_order(long: DataFrame, *, year: str = "Year", series: str = "series",
                     order: str = "series_no", value: str = "value") -> DataFrame:
    """``(series, position)``: early peaks in the middle, sides kept in balance.

    The walk goes from the earliest peak to the latest and knows only the two
    sides' totals: one task, a row per series, nothing held in memory.
    """
    per = long.groupBy(series, order).agg(
        F.sum(value).cast("double").alias("total"),
        F.min_by(year, F.struct((-F.col(value)).alias("v"), F.col(year).alias("y"))).alias("peak"))
    ordered = per.repartition(1).sortWithinPartitions("peak", order).select(F.col(series).cast("string").alias("series"), "total")
    sides = ordered.mapInArrow(_sides, "series string, side int, place long")
    bottoms = sides.agg(F.count_if(F.col("side") == 0)).scalar()
    position = F.when(F.col("side") == 0, bottoms - 1 - F.col("place")).otherwise(bottoms + F.col("place"))
    return sides.select(position.cast("int").alias("position"), F.col("series").alias(series))


def _sides(batches):
    """Each series goes to the side with the smaller total, the lower one (0) if they are equal, further out than those before."""
    totals, placed = [0.0, 0.0], [0, 0]
    for batch in batches:
        side, place = [], []
        for total in batch.column(1).to_pylist():
            s = int(totals[1] < totals[0])
            side.append(s)
            place.append(placed[s])
            totals[s] += total or 0.0
            placed[s] += 1
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(side, pa.int32()), pa.array(place, pa.int64())], names=["series", "side", "place"])


def reorder(long: DataFrame, positions: DataFrame, *, series: str = "series", order: str = "series_no") -> DataFrame:
    """Replace the series numbers by new positions."""
    return long.drop(order).join(positions.withColumnRenamed("position", order), series)


def label_anchors(layers: DataFrame, *, year: str = "Year", series: str = "series",
                  min_thickness: float = 10.0) -> DataFrame:
    """Per series, the year nearest its middle where it is at least half its greatest thickness."""
    thick = F.col("y1") - F.col("y0")
    w = Window.partitionBy(series)
    near = (layers.withColumn("thickness", thick)
            .withColumn("__max", F.max("thickness").over(w)).withColumn("__mid", F.avg(year).over(w))
            .where(F.col("thickness") >= F.col("__max") * 0.5))
    nearest = F.struct(F.abs(F.col(year) - F.col("__mid")).alias("d"), F.col(year).alias("y"))
    best = near.groupBy(series).agg(F.min_by(
        F.struct(F.col(year).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"), "thickness"), nearest).alias("b"))
    return best.select(series, "b.x", "b.y", "b.thickness").where(F.col("thickness") > min_thickness)


def middle_points(layers: DataFrame, *, year: str = "Year", series: str = "series",
                  min_thickness: float = 3.0) -> DataFrame:
    """The middle year of every series; thin ones are left out."""
    w = Window.partitionBy(series)
    picked = (layers.withColumn("__i", F.row_number().over(w.orderBy(year)) - 1)
              .withColumn("__n", F.count(F.lit(1)).over(w))
              .where(F.col("__i") == F.floor(F.col("__n") / 2)))
    return picked.withColumn("thickness", F.col("y1") - F.col("y0")).where(
        F.col("thickness") >= min_thickness).select(series, year, "y0", "y1", "thickness")


# --- events -----------------------------------------------------------------------

def with_events(yearly: DataFrame, events: DataFrame | None = None, *, year: str = "Year",
                first: int | None = None, last: int | None = None) -> DataFrame:
    """Attach the events of each year; without limits the table's own years decide.

    The default event list is a constant of five rows; a supplied one is joined
    by whatever strategy its size allows.
    """
    if events is None:
        events = F.broadcast(literal_table(yearly.sparkSession, vocab.INDUSTRY_EVENTS, ["event_year", "event", "description"]))
    if first is not None:
        events = events.where(F.col("event_year") >= first)
    if last is not None:
        events = events.where(F.col("event_year") <= last)
    return yearly.join(events, F.col(year) == F.col("event_year"), "left").drop("event_year")
