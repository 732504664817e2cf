"""Sorting, pages, tails, top groups, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.operators.windows import first_rows

PAGE_SIZES = (1, 100)
TAIL_SIZES = (1, 10_000)


def top_rows(df: DataFrame, order: list[Column | str], n: int, skip: int = 0) -> DataFrame:
    """Rows `skip + 1` to `skip + n` by `order`: each task keeps only its own first rows, on the scan's own tasks."""
    return df.orderBy(*order).offset(skip).limit(n)


def sort_by(df: DataFrame, col: str, *ties: str) -> DataFrame:
    """Ascending, with ties broken by `ties`, so that equal values can be sorted by several tasks."""
    return _sorted(df, [F.asc(col)], [F.asc(c) for c in ties])


def newest_first(df: DataFrame, ts: str, *ties: str) -> DataFrame:
    return _sorted(df, [F.desc(ts)], [F.desc(c) for c in ties])


def _sorted(df: DataFrame, order: list[Column], ties: list[Column]) -> DataFrame:
    if ties:
        return df.orderBy(*order, *ties)
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    return numbered.orderBy(*order, "_tie").drop("_tie")


def page_of(df: DataFrame, order: list[str], page: int = 1, size: int = 20) -> DataFrame:
    """Page `page` (from 1) of the rows, newest first by the `order` columns, which must tell all rows apart."""
    if page < 1 or not PAGE_SIZES[0] <= size <= PAGE_SIZES[1]:
        raise ValueError("page must be at least 1 and size within 1-100")
    return top_rows(df, [F.desc(c) for c in order], size, (page - 1) * size)


def tail(df: DataFrame, ts: str, n: int = 500, ties: list[str] = ()) -> DataFrame:
    """The `n` newest rows of the whole selection, newest first."""
    if not TAIL_SIZES[0] <= n <= TAIL_SIZES[1]:
        raise ValueError("n must be within 1-10000")
    return top_rows(df, [F.desc(c) for c in [ts, *ties]], n)


def keyset(df: DataFrame, key: str, after: object = None, size: int = 1000, tie: str | None = None) -> DataFrame:
    """`size` rows after a key, each with `is_truncated` and the `next_token` to go on from.

    A key that repeats needs a `tie` column that tells its rows apart; `after` and the token then are (key, tie) pairs.
    """
    order = [key, tie] if tie else [key]
    rest = df
    if after is not None and tie:
        rest = df.filter((F.col(key) > after[0]) | ((F.col(key) == after[0]) & (F.col(tie) > after[1])))
    elif after is not None:
        rest = df.filter(F.col(key) > after)
    ahead = top_rows(rest, order, size + 1)
    # These windows see at most size + 1 rows.
    whole = Window.partitionBy()
    numbered = ahead.withColumns(
        {
            "_position": F.row_number().over(Window.orderBy(*order)),
            "is_truncated": F.count("*").over(whole) > size,
        }
    ).filter(F.col("_position") <= size)
    last = F.struct(key, tie) if tie else F.col(key)
    token = F.when(F.col("is_truncated"), F.max(last).over(whole))
    return numbered.withColumn("next_token", token).drop("_position")


def topk_groups(df: DataFrame, keys: list[str], value: Column, k: int, out: str = "total") -> DataFrame:
    """The `k` groups with the largest aggregate `value`; ties go to the smaller keys."""
    groups = df.groupBy(*keys).agg(value.alias(out))
    return groups.orderBy(F.desc(out), *keys).limit(k)


def topk_per(df: DataFrame, part: list[str], val: str, k: int, ties: list[str] = ()) -> DataFrame:
    """The `k` largest rows within each part."""
    return first_rows(df, part, [F.desc(val), *[F.asc(c) for c in ties]], k)


def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the first by `order`."""
    return first_rows(df, keys, [F.asc(c) for c in order])


def dedup_events(df: DataFrame, ts: str, tie: str) -> DataFrame:
    """Accept each (job_id, retry_count) once: its first event."""
    return dedup(df, ["job_id", "retry_count"], [ts, tie])
