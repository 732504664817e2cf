"""Per-key row order: moving averages, newest rows, version numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.scalars import round2
from lakekit.operators.ordered import Ordered


def first_rows(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first `k` rows of each key; Spark cuts each key in every input task before the shuffle too, while k is within its own limit."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(spec)).filter(F.col("_rank") <= k).drop("_rank")


def moving_avg(
    df: DataFrame,
    key: str,
    order: list[str],
    col: str,
    n: int = 3,
    out: str = "moving_avg",
    run_rows: int | None = None,
) -> DataFrame:
    """Mean of this row and the `n - 1` before it; shorter at the start of a key."""

    def add(rows: DataFrame, spec) -> DataFrame:
        frame = spec.rowsBetween(1 - n, 0)
        return rows.withColumn(out, round2(F.avg(col).over(frame)))

    return Ordered(df, [key], order, run_rows).sliding(n - 1, add).result()


def latest_row(df: DataFrame, keys: list[str], ts: str, tie: list[str] = ()) -> DataFrame:
    """The newest row of each key."""
    return first_rows(df, keys, [F.desc(c) for c in [ts, *tie]])


def number_versions(
    df: DataFrame, keys: list[str], order: list[str], out: str = "version", run_rows: int | None = None
) -> DataFrame:
    """1..n for each key in `order`."""
    return Ordered(df, keys, order, run_rows).running(sums={out: F.lit(1)}).result()


def next_version(history: DataFrame, tables: DataFrame, key: str, version: str = "version") -> DataFrame:
    """The version number the next change of each table gets; 1 for a table without history."""
    newest = history.groupBy(key).agg(F.max(version).alias("_newest"))
    return tables.join(newest, key, "left").select(
        *tables.columns, (F.coalesce("_newest", F.lit(0)) + 1).alias("next_version")
    )
