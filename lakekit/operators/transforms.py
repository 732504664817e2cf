"""Projections, filters and rules."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalars import all_of, round2

# Tax rate, bucket edges and labels, name rules, closed sets.
TAX_RATE = "1.18"
BUCKET_EDGES = [50, 200]
BUCKET_LABELS = ["low", "medium", "high"]
IDENTIFIER = r"^[a-zA-Z_][a-zA-Z0-9_]*$"
IDENTIFIER_LENGTH = (1, 255)
BUCKET_NAME = r"^[a-z0-9][a-z0-9.-]*[a-z0-9]$"
BUCKET_NAME_LENGTH = (3, 63)
JOB_TYPES = ["spark_sql", "spark_etl", "spark_ml", "spark_streaming"]
LOG_SOURCES = ["stdout", "stderr", "driver", "executor", "all"]
TABLE_TYPES = ["ICEBERG", "DELTA", "HIVE", "PARQUET"]


def with_tax(df: DataFrame, col: str, out: str = "amount_tax", rate: str = TAX_RATE) -> DataFrame:
    return df.withColumn(out, round2(F.col(col) * F.lit(Decimal(rate))))


def product(a: str, b: str) -> Column:
    """Quantity times price, not rounded."""
    return F.col(a) * F.col(b)


def with_product(df: DataFrame, a: str, b: str, out: str = "total_price") -> DataFrame:
    return df.withColumn(out, round2(product(a, b)))


def bucketize(
    df: DataFrame,
    col: str,
    out: str = "amount_bucket",
    edges: list[float] = BUCKET_EDGES,
    labels: list[str] = BUCKET_LABELS,
) -> DataFrame:
    """Half-open buckets below each edge; nulls and values past the last edge get the last label."""
    pairs = list(zip(edges, labels))
    bucket = F.when(F.col(col) < pairs[0][0], pairs[0][1])
    for edge, label in pairs[1:]:
        bucket = bucket.when(F.col(col) < edge, label)
    return df.withColumn(out, bucket.otherwise(labels[-1]))


def with_flag(df: DataFrame, condition: Column, out: str) -> DataFrame:
    return df.withColumn(out, condition)


def stamp(df: DataFrame, out: str = "processed_at") -> DataFrame:
    """The time of the query, equal for all of its rows."""
    return df.withColumn(out, F.current_timestamp())


def where_gt(df: DataFrame, col: str, value: object) -> DataFrame:
    return df.filter(F.col(col) > value)


def where_ne(df: DataFrame, col: str, value: object) -> DataFrame:
    """Rows with another value; null rows are dropped as well."""
    return df.filter(F.col(col) != value)


def selectivity(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("matched"), F.count("*").alias("total"))


def where_all(df: DataFrame, **wanted: object) -> DataFrame:
    """Keep rows equal to every value given; None and empty values are no condition."""
    return df.filter(all_of([F.col(c) == v for c, v in wanted.items() if v is not None and v != ""]))


def match_labels(df: DataFrame, source: str = "all", **labels: str) -> DataFrame:
    """Exact label match; `source='all'` accepts every source."""
    if source != "all":
        labels["source"] = source
    return df.filter(all_of([F.col(c) == v for c, v in labels.items()]))


def match_regex(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """The whole value must match."""
    return df.filter(F.col(col).rlike(f"^(?:{pattern})$"))


def contains(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.col(col).contains(text))


def in_range(df: DataFrame, ts: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Rows with start <= ts < end; by default the 24 hours up to now."""
    kind = df.schema[ts].dataType

    def at(moment: datetime) -> Column:
        return F.lit(moment.isoformat(sep=" ")).cast(kind)

    upper = at(end) if end else F.current_timestamp().cast(kind)
    if start:
        lower = at(start)
    else:
        lower = at(end - timedelta(hours=24)) if end else upper - F.expr("INTERVAL 24 HOURS")
    return df.filter((F.col(ts) >= lower) & (F.col(ts) < upper))


def check_pattern(
    df: DataFrame, col: str, regex: str = IDENTIFIER, low: int = 1, high: int = 255, out: str = "is_valid"
) -> DataFrame:
    """Flag names of allowed form and length; a null name is not valid."""
    ok = F.col(col).rlike(regex) & F.length(col).between(low, high)
    return df.withColumn(out, F.coalesce(ok, F.lit(False)))


def check_enum(df: DataFrame, col: str, values: list[str], out: str = "is_valid") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(col).isin(values), F.lit(False)))
