"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import lookup
from .store import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of all nodes of the edges ``a, b``.

    Nodes are of any type with an order. Alternates two star steps, each a
    minimum per node looked up again by the edges, until every node points at
    one node that points at none; every table is as large as the edges, and a
    hub's edges are split over tasks. Rows with a null end and loops are no edges.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("a is not null and b is not null and u <> v").distinct(), "edges")
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = lookup(both, _lowest(both), ["u"], "inner").where("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
        low = _lowest(large)
        small = (lookup(large, low, ["u"], "inner").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(low.select("u", F.col("low").alias("v"))).distinct())
        e = stored(small, "edges")
        ends = (e.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
                .unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
                .groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")))
        if ends.where("out > 1 or out = 1 and into = 1").isEmpty():
            break
    tops = e.select("v").distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(tops.select(F.col("v").alias("node"), F.col("v").alias("component"))))


def _lowest(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("low"))
