"""Joins. Spark picks the strategy; adaptive execution splits skewed join partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalars import round2


def join_inner(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Equi join by name: the key first, then the left, then the right columns."""
    return left.join(right, key, "inner")


def join_summary(fact: DataFrame, dim: DataFrame, key: str, dims: list[str], col: str) -> DataFrame:
    """Count and sum of the fact column by columns of the dimension.

    Joined first, so that a small dimension is broadcast and the fact table is not shuffled at all; adaptive execution splits a
    key that holds much of the table where the join does shuffle.
    """
    joined = fact.select(key, col).join(dim.select(key, *dims), key)
    return joined.groupBy(*dims).agg(F.count("*").alias("orders"), round2(F.sum(col)).alias("revenue"))


def lookup(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_name: tuple[str, object],
    child_name: tuple[str, object],
) -> DataFrame:
    """Children of a given name under a parent of a given name."""
    parents = parent.filter(F.col(parent_name[0]) == parent_name[1])
    children = child.filter(F.col(child_name[0]) == child_name[1])
    return children.join(parents, key)


def child_count(parent: DataFrame, child: DataFrame, key: str, out: str = "child_count") -> DataFrame:
    """Number of children for each parent, 0 when it has none."""
    counts = child.groupBy(key).agg(F.count("*").alias(out))
    return parent.join(counts, key, "left").withColumn(out, F.coalesce(out, F.lit(0)))
