"""Time-series queries over long tables of (series labels, time, value).

Rates are not extrapolated to the window edges: the growth between two samples counts in the
window of the later one, and the first sample of a series adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.operators.ordered import Ordered
from lakekit.operators.transforms import match_regex
from lakekit.operators.windows import latest_row

# Fixed value: statuses that count as errors.
ERROR_STATUS = "4xx|5xx"


def latest(df: DataFrame, series: list[str], ts: str, tie: list[str] = ()) -> DataFrame:
    """The last sample of each series."""
    return latest_row(df, series, ts, tie)


def deltas(
    df: DataFrame,
    series: list[str],
    order: list[str],
    val: str,
    out: str = "delta",
    run_rows: int | None = None,
) -> DataFrame:
    """Growth of a counter since the sample before; a lower value means it restarted from zero."""

    def add(rows: DataFrame, spec) -> DataFrame:
        return rows.withColumn("_previous", F.lag(val).over(spec))

    value, previous = F.col(val), F.col("_previous")
    grown = F.when(previous.isNull(), 0).when(value < previous, value).otherwise(value - previous)
    return (
        Ordered(df, series, order, run_rows)
        .sliding(1, add)
        .map(lambda rows: rows.withColumn(out, grown).drop("_previous"))
        .result()
    )


def width_seconds(width: str) -> int:
    """`15 minutes` as seconds."""
    amount, unit = width.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _windowed(df: DataFrame, by: list[str], ts: str, width: str, *aggs: Column) -> DataFrame:
    grouped = df.groupBy(F.window(ts, width).alias("_window"), *by).agg(*aggs)
    names = [c for c in grouped.columns if c not in ("_window", *by)]
    return grouped.select(F.col("_window.start").alias("window_start"), *by, *names)


def increase(
    df: DataFrame,
    series: list[str],
    order: list[str],
    val: str,
    width: str = "15 minutes",
    run_rows: int | None = None,
) -> DataFrame:
    """Growth of each counter in each window; the first `order` column is the time."""
    grown = deltas(df, series, order, val, run_rows=run_rows)
    return _windowed(grown, series, order[0], width, F.sum("delta").alias("increase"))


def rate(
    df: DataFrame,
    series: list[str],
    by: list[str],
    order: list[str],
    val: str,
    width: str = "1 minute",
    run_rows: int | None = None,
) -> DataFrame:
    """Growth per second, summed over the series of each `by` group."""
    grown = deltas(df, series, order, val, run_rows=run_rows)
    per_second = (F.sum("delta") / F.lit(width_seconds(width))).alias("rate")
    return _windowed(grown, by, order[0], width, per_second)


def error_rate(
    df: DataFrame,
    series: list[str],
    by: list[str],
    order: list[str],
    val: str,
    status: str = "status",
    width: str = "5 minutes",
) -> DataFrame:
    return rate(match_regex(df, status, ERROR_STATUS), series, by, order, val, width)


def conditional_rates(
    df: DataFrame,
    series: list[str],
    order: list[str],
    val: str,
    filters: dict[str, Column],
    width: str = "5 minutes",
) -> DataFrame:
    """Several filtered rates side by side, from one pass."""
    grown = deltas(df, series, order, val)
    seconds = F.lit(width_seconds(width))
    sums = [
        (F.coalesce(F.sum(F.when(test, F.col("delta"))), F.lit(0)) / seconds).alias(name)
        for name, test in filters.items()
    ]
    return _windowed(grown, [], order[0], width, *sums)


def histogram(
    df: DataFrame, series: list[str], ts: str, col: str, bounds: list[float], width: str = "5 minutes"
) -> DataFrame:
    """Cumulative bucket counts for each series and window: `le` as text, last one `+Inf`."""
    names = [f"{b:g}" for b in bounds] + ["+Inf"]
    counts = [F.count_if(F.col(col) <= b).alias(n) for b, n in zip(bounds, names)]
    wide = _windowed(df, series, ts, width, *counts, F.count(col).alias("+Inf"))
    buckets = F.array(*[F.struct(F.lit(n).alias("le"), F.col(f"`{n}`").alias("cumulative")) for n in names])
    return wide.select("window_start", *series, F.inline(buckets))


def _rising(buckets: Column) -> Column:
    """Sorted buckets with each count at least that of the bucket before."""

    def upto(bucket: Column, at: Column) -> Column:
        counts = F.transform(F.slice(buckets, F.lit(1), at + 1), lambda b: b["_count"])
        return F.struct(bucket["_bound"].alias("_bound"), F.array_max(counts).alias("_count"))

    return F.transform(buckets, upto)


def quantile_over_time(
    df: DataFrame,
    q: float,
    series: list[str],
    by: list[str],
    order: list[str],
    val: str,
    le: str = "le",
    width: str = "5 minutes",
    run_rows: int | None = None,
) -> DataFrame:
    """Quantile in each window and `by` group, from bucket counters: one growing counter for each series and bound `le`.

    Buckets count by their growth in the window (resets as in `deltas`), summed over the series of a group.
    """
    grown = increase(df, [*dict.fromkeys([*series, le])], order, val, width, run_rows)
    return hist_quantile(grown, q, ["window_start", *by], le, "increase")


def hist_quantile(
    df: DataFrame, q: float, by: list[str], le: str = "le", cumulative: str = "cumulative"
) -> DataFrame:
    """Quantile from cumulative buckets, linear within the bucket that holds the rank.

    A group's array holds one entry for each bucket bound, as buckets are summed first. A bucket below a smaller one, as resets that
    only some buckets show can leave it, is raised to that one. Groups without growth or without `+Inf` give null.
    """
    bound = F.when(F.col(le) == "+Inf", F.lit(float("inf"))).otherwise(F.col(le).try_cast("double"))
    summed = df.groupBy(*by, bound.alias("_bound")).agg(F.sum(cumulative).alias("_count"))
    group = summed.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("_bound", "_count"))).alias("_buckets")
    )
    group = group.withColumn("_buckets", _rising(F.col("_buckets")))
    buckets = F.col("_buckets")
    total = F.element_at(buckets, -1)
    rank = total["_count"] * F.lit(q)
    ranked = group.withColumns(
        {
            "_hit": F.get(F.filter(buckets, lambda b: b["_count"] >= rank), F.lit(0)),
            "_below": F.try_element_at(F.filter(buckets, lambda b: b["_count"] < rank), F.lit(-1)),
            "_finite": F.try_element_at(
                F.filter(buckets, lambda b: b["_bound"] < F.lit(float("inf"))), F.lit(-1)
            ),
            "_rank": rank,
            "_total": total,
        }
    )
    low = F.coalesce(F.col("_below._bound"), F.lit(0.0))
    under = F.coalesce(F.col("_below._count"), F.lit(0))
    share = F.try_divide(F.col("_rank") - under, F.col("_hit._count") - under)
    inside = low + (F.col("_hit._bound") - low) * share
    complete = (F.col("_total._bound") == F.lit(float("inf"))) & (F.col("_total._count") > 0)
    value = F.when(
        complete,
        F.when(F.col("_hit._bound") == F.lit(float("inf")), F.col("_finite._bound")).otherwise(inside),
    )
    return ranked.select(*by, value.alias("quantile"))


def count_over_time(df: DataFrame, series: list[str], ts: str, width: str = "15 minutes") -> DataFrame:
    return _windowed(df, series, ts, width, F.count("*").alias("count"))
