"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of `edges(a, b)`, both long; component is the smallest node that it reaches.

    Each step is grouped minima (combined before the shuffle) and a join that adaptive execution splits where one
    node has very many edges. Every step is written to the shared scratch folder, so that no lineage builds up and a
    lost executor costs one step. Nothing but two numbers for each step reaches the driver.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(pairs: DataFrame, keep) -> DataFrame:
        low = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        return pairs.join(low, "a").where(keep).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    was, at = None, state(now)
    while at != was:
        large = star(both(now), F.col("b") > F.col("a")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            down.join(low, "a").select("b", "low").where("b <> low").toDF("a", "b").unionByName(low.toDF("a", "b")).distinct()
        )
        now = materialize(small, "edges")
        was, at = at, state(now)
    # Every edge now points at the smallest node of its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
