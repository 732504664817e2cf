"""Grouped and global aggregates; all of them combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalars import round2
from lakekit.operators.transforms import where_all


def summarize(df: DataFrame, keys: list[str], col: str, digits: int | None = None) -> DataFrame:
    """Count, sum and average of an amount by keys, rounded when `digits` is given.

    Sums of doubles depend on row order in their last digits; give a decimal column where that matters.
    """
    total, mean = F.sum(col), F.avg(col)
    if digits is not None:
        total, mean = F.round(total, digits), F.round(mean, digits)
    return df.groupBy(*keys).agg(
        F.count("*").alias("count"), total.alias(f"total_{col}"), mean.alias(f"avg_{col}")
    )


def distribution(df: DataFrame, key: str, col: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count("*").alias("n"),
        round2(F.mean(col)).alias("mean"),
        round2(F.stddev(col)).alias("stddev"),
        round2(F.min(col)).alias("min"),
        round2(F.max(col)).alias("max"),
    )


def pivot_sum(df: DataFrame, row: str, col: str, val: str, values: list | None = None) -> DataFrame:
    """Rounded sums of `val`, one column for each value of `col`.

    Given `values`, the job that looks for them is saved.
    """
    cells = df.groupBy(row).pivot(col, values) if values else df.groupBy(row).pivot(col)
    return cells.agg(round2(F.sum(val)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def filtered_total(df: DataFrame, order: list, page: int = 1, size: int = 20, **wanted: object) -> DataFrame:
    """One page of the filtered rows with the total of all filtered rows beside it.

    The total is a scalar subquery, so no window has to hold the whole selection in one task.
    """
    from lakekit.operators.paging import page_of

    kept = where_all(df, **wanted)
    total = kept.agg(F.count("*")).scalar()
    return page_of(kept, order, page, size).withColumn("total", total)


def dedup_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after deduplication by keys (nulls count as one key), and those removed."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
