"""Writing datasets and named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write Parquet. With `partition_by` the rows are first rebalanced by those columns.

    Rebalancing gathers small partitions into few files, while a partition that holds much of
    the data is spread over several tasks and files.
    """
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def sql_table(spark: SparkSession, name: str, df: DataFrame, location: str | None = None) -> DataFrame:
    """Create table `name` with the columns of `df`, insert `df`, and return the table."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{place}")
    spark.sql(f"INSERT INTO {name} SELECT * FROM {{rows}}", rows=df)
    return spark.sql(f"SELECT * FROM {name}")
