"""Mixing sources to target weights by Pareto order sampling.

A source's target is met by whole copies of every document first. What is left
is sampled without replacement with unequal inclusion probabilities: documents
are ranked by their random odds divided by their inclusion odds, and the first
ones are taken until the words are reached.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table
from .store import stored

#: No source and no document is taken more often.
MOST = 2.0
#: A document of twice the length gets its expected copies multiplied by 2 ** -DAMPING.
DAMPING = 0.1
#: Documents of a source that one task ranks together, about.
BIN_ROWS = 5000


def _counted(batches):
    """Sizes, and a number for every row that is its own once the rows are stored."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        counts = [W.Words(chunk, lower=False).count for _, chunk in W.text_chunks(batch.column(0).to_pylist())]
        numbers = pa.array(np.arange(number, number + batch.num_rows))
        number += batch.num_rows
        yield pa.RecordBatch.from_arrays([numbers, pa.array(np.concatenate(counts), pa.int64()), *batch.columns[1:]],
                                         names=["row_number", "size", *batch.schema.names[1:]])


def _sized(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``row_number, size, doc_id, source`` (and ``keep``) of every row, stored."""
    rows = docs.select(F.col("text").cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"), *[F.col(c) for c in keep])
    schema = ", ".join(["row_number long", "size long", "doc_id long", "source string", *[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[3:]]])
    return stored(rows.mapInArrow(_counted, schema), "sizes")


def _candidate(w: Window, capacity: Column, share: Column, total: Column, ratio: Column) -> Column:
    """What each row would have as level if the rows before it reach their capacity and it does not.

    Rows come in the order of ``ratio = capacity / share``.
    """
    before = F.coalesce(F.sum(capacity).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(share).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.try_divide(total - before, rest)
    return F.when(level <= ratio, F.struct(rest.alias("rest"), level.alias("level")))


def _level(candidate: str, group: Window) -> Column:
    """The level at which ``share * level``, cut at ``capacity``, sums to the total: the first candidate's."""
    return F.coalesce(F.max(candidate).over(group)["level"], F.lit(float("inf")))


def source_targets(sizes: DataFrame, *, share: float = 1.5, cycle: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """``source, source_size, target``: weights repeat over the sources in code point order, null last.

    One row per source goes through the windows; sources are named by whoever
    sets the weights, so they are few.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(x)) for x in cycle])
    per = per.withColumn("weight", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(cycle) + 1).cast("int")))
    cap = MOST * F.col("source_size")
    per = per.withColumn("ratio", cap / F.col("weight"))
    filling = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    goal = share * F.sum("source_size").over(everything)
    per = per.withColumn("level", _candidate(filling, cap, F.col("weight"), goal, F.col("ratio")))
    return per.select("source", "source_size", F.least(
        cap, F.col("weight") * _level("level", everything)).alias("target"))


def _unit(seed: int) -> Column:
    """A number in (0, 1) for every doc_id."""
    return (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def mixed(docs: DataFrame, *, share: float = 1.5, cycle: tuple[int, ...] = (3, 1, 2), seed: int = 7) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``docs`` has ``doc_id, text, source``; texts without words have size 0 and
    are never taken. Ties in the order go by doc_id and size; rows alike in
    both are interchangeable. The words of a source miss its target by at most
    half of the document at the cut. Whole texts are counted, very long ones
    too; other columns are not read.
    """
    return _taken(_sized(docs), share, cycle, seed).drop("row_number")


def _taken(sizes: DataFrame, share: float = 1.5, cycle: tuple[int, ...] = (3, 1, 2), seed: int = 7) -> DataFrame:
    """How often each of the sized rows is taken."""
    # Size classes by powers of two; a class's expected copies follow from its length.
    length_class = F.length(F.bin("size"))
    sizes = sizes.withColumn("class", F.when(F.col("size") == 0, 0).otherwise(length_class))
    targets = stored(source_targets(sizes, share=share, cycle=cycle), "targets")
    per = (sizes.groupBy("source", "class").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
           .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    gain = F.pow(F.lit(2.0), -DAMPING * F.col("class"))
    own = Window.partitionBy("source")
    by_class = own.orderBy("class")
    level = _candidate(by_class, MOST * F.col("words"), gain * F.col("words"), F.col("target"), MOST / gain)
    per = per.withColumn("level", level).withColumn("level", _level("level", own))
    per = (per.withColumn("expected", F.least(F.lit(MOST), gain * F.col("level")))
           .withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole")))
    some = F.when(F.col("p") > 0, F.col("words")).otherwise(0)
    per = (per.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(own))
           .withColumn("mean_p", F.least(F.try_divide("rest", F.sum(some).over(own)), F.lit(1 - 1e-9)))
           .withColumn("bins", F.ceil(F.sum("docs").over(own) / BIN_ROWS))
           .select(F.col("source").alias("s"), F.col("class").alias("c"), "source_size", "target", "whole", "p",
                   "rest", "mean_p", "bins"))
    placed = sizes.join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c"))).drop("s", "c")
    odds = lambda x: x / (1 - x)
    u = _unit(seed)
    placed = placed.withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), odds(u) / odds(F.col("p"))))
    even = F.col("rank") * odds(F.greatest("mean_p", F.lit(1e-12)))  # close to evenly spread after x / (1 + x)
    placed = placed.withColumn("bin", F.least(F.col("bins") - 1, F.floor(F.col("bins") * even / (1 + even))))
    ranked = F.col("rank").isNotNull()
    totals = placed.where(ranked).groupBy("source", "bin").agg(F.sum("size").alias("bin_words"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("s"), F.col("bin").alias("b"),
                           F.coalesce(F.sum("bin_words").over(before), F.lit(0)).alias("before"))
    # Rows outside the sampling have no bin: they are spread by hash, for the window below is theirs too.
    spread = F.when(~ranked, F.pmod(F.xxhash64("doc_id", "size"), F.col("bins")))
    placed = placed.withColumn("spread", spread)
    running = (Window.partitionBy("source", "bin", "spread").orderBy("rank", "doc_id", "size")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = (placed.withColumn("upto", F.sum("size").over(running))
              .join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")), "left"))
    middle = F.col("before") + F.col("upto") - F.col("size") / 2
    extra = F.when(ranked & (middle <= F.col("rest")), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0).cast("long")
    return summed.select("row_number", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: each row of ``docs`` as often as it is taken, with its own columns.

    What is taken is settled on numbers of rows; the rows themselves move once, to meet the outcome.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(c) for c in columns]).alias("__row"), "doc_id", "text", "source")
    rows = _sized(packed, keep=("__row",))
    taken = _taken(rows.drop("__row"), **options).where("copies > 0").select("row_number", "copies")
    found = rows.select("row_number", "__row").join(taken, "row_number")
    return found.select("__row.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).select(*columns)


@query()
def op7_source_mixture(spark, folder):
    return mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
