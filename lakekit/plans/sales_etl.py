"""Sales load: tax, bucket and load time; partitioned write; summary by two keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.aggregates import summarize
from lakekit.operators.transforms import bucketize, stamp, with_tax
from lakekit.sources.sinks import write


def transform(df: DataFrame) -> DataFrame:
    return stamp(bucketize(with_tax(df, "amount"), "amount"))


def sales_etl(df: DataFrame, path: str, date: str, mode: str = "append") -> DataFrame:
    """Load one day of sales into `path` and return the summary of the rows loaded."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    rows = transform(df.withColumn("txn_date", F.lit(date)))
    write(rows, path, mode, ["txn_date"])
    return summarize(rows, ["category", "country"], "amount", digits=2)
