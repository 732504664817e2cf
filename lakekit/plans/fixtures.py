"""The given tables in the shapes that the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions.scalars import json_field
from lakekit.operators.ordered import Ordered
from lakekit.sources.scan import scan


def table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    return scan(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", cols)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as sales: amount by category and country."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("category"),
        F.col("l_linestatus").alias("country"),
    )


def pipeline_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as item orders; open lines are pending."""
    status = F.when(F.col("l_linestatus") == "O", "pending").otherwise("delivered")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("item_"), F.col("l_partkey").cast("string")).alias("item"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        status.alias("status"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("tier"),
        F.col("c_nationkey").alias("country"),
    )


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows(table(spark, sf_dir, "events"))


def log_rows(events: DataFrame) -> DataFrame:
    """events (batch or stream) as log rows; some have no source or level."""
    kind = F.col("event_type")
    source = (
        F.when(kind == "error", "stderr").when(kind == "view", "driver")
        .when(kind == "purchase", "executor").when(kind == "click", "stdout")
    )
    level = F.when(kind == "error", "ERROR").when(kind == "click", "WARN").when(kind == "view", "INFO")
    return events.select(
        "event_id",
        "ts",
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        source.alias("source"),
        level.alias("level"),
        F.concat(F.coalesce(level, F.lit("NONE")), F.lit(" "), F.col("props")).alias("message"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as text lines; signup lines have no prefix."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    full = F.format_string("[%s] [%s] %s", stamp, F.upper("event_type"), F.concat_ws(" ", "event_id", "props"))
    bare = F.concat_ws(" ", F.lit("raw"), "event_id", "props")
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "signup", bare).otherwise(full).alias("line")
    )


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request counters that restart every day: one series for each service, handler and status."""
    service = F.concat(F.lit("service-"), F.substring(F.col("user_id").cast("string"), -1, 1))
    kind = F.col("event_type")
    status = F.when(kind == "error", "5xx").when(kind == "signup", "4xx").otherwise("2xx")
    samples = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"]).select(
        "event_id",
        "ts",
        service.alias("job"),
        kind.alias("handler"),
        status.alias("status"),
        F.to_date("ts").alias("day"),
    )
    keys = ["job", "handler", "status"]
    return Ordered(samples, [*keys, "day"], ["ts", "event_id"]).running(sums={"value": F.lit(1)}).result().drop("day")


COUNTER_SERIES = ["job", "handler", "status"]


def job_events(source: DataFrame) -> DataFrame:
    """events (batch or stream) as job events; a small `k` is a cancel request."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "signup", "QUEUED").when(kind == "click", "PROVISIONING").when(kind == "view", "RUNNING")
        .when(kind == "purchase", "SUCCESS").otherwise("FAILED")
    )
    cancel = json_field("props", "$.k", "int") < 10
    return source.select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(~cancel, status).alias("status"),
        cancel.alias("is_cancel"),
        F.when(~cancel & (kind == "error"), F.concat(F.lit("failed at "), F.col("event_id").cast("string"))).alias(
            "error_message"
        ),
        (F.col("user_id") % 4).cast("int").alias("max_retries"),
        F.when(~cancel & kind.isin("view", "purchase"), F.concat(F.lit("pod-"), F.col("event_id").cast("string")))
        .otherwise("")
        .alias("container_id"),
    )


FIELD = "struct<name:string,type:string,nullable:boolean,description:string>"


def schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as change requests on a table with two fields."""

    def field(name, kind: str):
        return F.struct(
            name.alias("name"), F.lit(kind).alias("type"), F.lit(True).alias("nullable"),
            F.lit(None).cast("string").alias("description"),
        )

    def array(kind: str, *values):
        return F.array(*values).cast(f"array<{kind}>")

    pair = "struct<old:string,new:string>"
    kind = F.col("event_type")
    number = json_field("props", "$.k")
    added = array(FIELD, field(F.concat(F.lit("c"), number), "string"))
    none = array(FIELD)
    renamed = array(pair, F.struct(F.lit("amount").alias("old"), F.lit("total").alias("new")))
    missing = array(pair, F.struct(F.lit("ghost").alias("old"), F.lit("spirit").alias("new")))
    return table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"]).select(
        F.col("user_id").alias("table_id"),
        "ts",
        "event_id",
        array(FIELD, field(F.lit("id"), "long"), field(F.lit("amount"), "decimal")).alias("fields"),
        F.when(kind.isin("signup", "click"), added).otherwise(none).alias("add"),
        F.when(kind == "purchase", array("string", F.lit("old_column"))).otherwise(array("string")).alias("drop"),
        F.when(kind == "click", renamed).when(kind == "error", missing).otherwise(array(pair)).alias("rename"),
        F.concat(F.lit("user-"), number).alias("changed_by"),
    )


def schema_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as change requests that build on each other: sign-ups add columns, clicks rename them on, purchases drop them, errors
    rename what is seldom there; other events request nothing."""
    number = json_field("props", "$.k", "int") % 10
    name, onward = F.concat(F.lit("c"), number), F.concat(F.lit("c"), (number + 1) % 10)
    kind = F.col("event_type")
    field = F.struct(name.alias("name"), F.lit("string").alias("type"), F.lit(True).alias("nullable"), F.lit(None).cast("string").alias("description"))
    pair = F.when(kind == "click", F.struct(name.alias("old"), onward.alias("new")))
    pair = pair.when(kind == "error", F.struct(F.lit("amount").alias("old"), name.alias("new")))
    return table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"]).select(
        F.col("user_id").alias("table_id"),
        "ts",
        "event_id",
        F.when(kind == "signup", F.array(field)).cast(f"array<{FIELD}>").alias("add"),
        F.when(kind == "purchase", F.array(name)).alias("drop"),
        F.when(pair.isNotNull(), F.array(pair)).alias("rename"),
        F.concat(F.lit("user-"), number).alias("changed_by"),
    )


def event_schema(spark: SparkSession, sf_dir: str) -> T.StructType:
    return table(spark, sf_dir, "events").schema
