"""Queries for sources, generators and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakekit.plans.fixtures import table
from lakekit.plans.registry import query
from lakekit.session import scratch_path
from lakekit.sources import synth as s
from lakekit.sources.json_events import decode_events, encode_events
from lakekit.sources.scan import inventory, preview, scan
from lakekit.sources.sinks import sql_table, write

ORDERS_SQL = "SELECT * FROM orders"


@query("scan_parquet", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def scan_parquet(spark, d):
    return scan(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_extendedprice"])


# The row numbers of the generated tables are the order keys, so they grow with the orders.
# Random values have no SQL twin: the query checks each row against the domains of its columns.
@query("synth_table", "SELECT o_orderkey + 1 AS transaction_id, '2026-03-28' AS txn_date, true AS in_domain FROM orders")
def synth_table(spark, d):
    categories = ["electronics", "clothing", "food", "home", "sports"]
    spec = {
        "transaction_id": s.sequence(1),
        "amount": s.uniform(5.0, 500.0),
        "category": s.choice(categories),
        "txn_date": s.constant("2026-03-28"),
        "customer_id": s.prefixed_int("customer_", 1, 200),
        "random_int": s.uniform_int(1, 100),
        "measurement": s.gauss(100, 25),
    }
    rows = s.synth_columns(table(spark, d, "orders"), "o_orderkey", spec, seed=7)
    in_domain = (
        F.col("amount").between(5, 500)
        & (F.round("amount", 2) == F.col("amount"))
        & F.col("category").isin(categories)
        & F.regexp_extract("customer_id", "^customer_([0-9]+)$", 1).try_cast("int").between(1, 200)
        & F.col("random_int").between(1, 100)
        & F.col("measurement").between(-150, 350)
    )
    return rows.select("transaction_id", "txn_date", in_domain.alias("in_domain"))


@query(
    "synth_padded_id",
    """SELECT o_orderkey AS id,
              'txn_' || CASE WHEN o_orderkey < 1000000 THEN lpad(o_orderkey::VARCHAR, 6, '0')
                             ELSE o_orderkey::VARCHAR END AS txn_ref
       FROM orders""",
)
def synth_padded_id(spark, d):
    return s.synth_columns(table(spark, d, "orders"), "o_orderkey", {"id": s.sequence(), "txn_ref": s.padded("txn_")})


@query(
    "synth_modular_dups",
    "SELECT o_orderkey AS id, 'email_' || (o_orderkey % 300) || '@test.com' AS email FROM orders",
)
def synth_modular_dups(spark, d):
    spec = {"id": s.sequence(), "email": s.modular("email_", 300, "@test.com")}
    return s.synth_columns(table(spark, d, "orders"), "o_orderkey", spec)


@query(
    "synth_timeseries",
    "SELECT o_orderkey AS id, TIMESTAMP '2026-01-01' + to_hours(o_orderkey::INT) AS ts FROM orders",
)
def synth_timeseries(spark, d):
    spec = {"id": s.sequence(), "ts": s.hourly("2026-01-01")}
    return s.synth_columns(table(spark, d, "orders"), "o_orderkey", spec)


@query("sink_overwrite", ORDERS_SQL)
def sink_overwrite(spark, d):
    orders, path = table(spark, d, "orders"), scratch_path(spark, "overwrite")
    write(orders.select("o_orderkey"), path)
    write(orders, path)
    return spark.read.schema(orders.schema).parquet(path)


@query("sink_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def sink_append(spark, d):
    orders, path = table(spark, d, "orders"), scratch_path(spark, "append")
    write(orders, path, "append")
    write(orders, path, "append")
    return spark.read.schema(orders.schema).parquet(path)


@query("sink_partitioned", ORDERS_SQL)
def sink_partitioned(spark, d):
    orders, path = table(spark, d, "orders"), scratch_path(spark, "partitioned")
    write(orders, path, partition_by=["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path)


@query("sink_multi_partitioned", "SELECT *, strftime(o_orderdate, '%Y') AS year FROM orders")
def sink_multi_partitioned(spark, d):
    orders = table(spark, d, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    path = scratch_path(spark, "multi_partitioned")
    write(orders, path, partition_by=["o_orderstatus", "year"])
    return spark.read.schema(orders.schema).parquet(path)


@query("sql_table_roundtrip", ORDERS_SQL)
def sql_table_roundtrip(spark, d):
    name = f"orders_{uuid.uuid4().hex}"
    return sql_table(spark, name, table(spark, d, "orders"), scratch_path(spark, "table"))


@query("preview", "SELECT * FROM events ORDER BY event_id LIMIT 10")
def preview_rows(spark, d):
    return preview(table(spark, d, "events"), 10, ["event_id"])


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "object_inventory",
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS dataset, CAST(count(*) AS BIGINT) AS rows FROM {t}" for t in TABLES),
)
def object_inventory(spark, d):
    """The listed objects by dataset, with the rows that reading each object finds."""
    path = F.col("_metadata.file_path")
    root = d.rstrip("/").split("/")[-1]
    counted = None
    for name in TABLES:
        files = spark.read.parquet(f"{d}/{name}.parquet").groupBy(path.alias("path")).agg(F.count("*").alias("rows"))
        counted = files if counted is None else counted.unionByName(files)
    key = F.substring_index("path", f"/{root}/", -1)
    listed = inventory(spark, d).filter(F.col("key").rlike(r"\.parquet(/.*)?$"))
    return (
        listed.join(counted.select(key.alias("key"), "rows"), "key")
        .groupBy(F.substring_index("key", "/", 1).alias("dataset"))
        .agg(F.sum("rows").alias("rows"))
    )


@query(
    "json_event_source",
    "SELECT user_id::VARCHAR AS key, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)
def json_event_source(spark, d):
    messages = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"))
    return decode_events(messages, "k int")


@query(
    "json_event_sink",
    """SELECT user_id::VARCHAR AS key, * FROM events""",
)
def json_event_sink(spark, d):
    rows = table(spark, d, "events")
    path = scratch_path(spark, "json_events")
    write(encode_events(rows, "user_id"), path)
    return decode_events(spark.read.schema("key string, value string").parquet(path), rows.schema)
