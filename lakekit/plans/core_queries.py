"""Queries for projections, filters, joins, aggregates, quality rules and the two complete jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakekit.functions.scalars import money, round2
from lakekit.operators import aggregates as a
from lakekit.operators import joins as j
from lakekit.operators import quality as q
from lakekit.operators import transforms as t
from lakekit.plans import fixtures as fx
from lakekit.plans.order_flow import order_flow, prepare, rules
from lakekit.plans.registry import query
from lakekit.plans.sales_etl import sales_etl
from lakekit.session import scratch_path

SALES = """SELECT l_orderkey AS transaction_id, l_extendedprice AS amount, l_returnflag AS category,
                  l_linestatus AS country FROM lineitem"""
PRODUCT = "(l_quantity * l_extendedprice)"


def rounded(value: str) -> str:
    """Half-up rounding of a double's decimal digits, as Spark does it; 25 places hold all of them."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,25)), 2) AS DOUBLE)"


PREPARED = f"""
    SELECT l_orderkey AS order_id, 'item_' || l_partkey AS item, CAST(l_quantity AS INT) AS quantity,
           l_extendedprice AS unit_price, 'delivered' AS status,
           {rounded(PRODUCT)} AS total_price, {PRODUCT} > 1000 AS is_high_value
    FROM lineitem WHERE l_linestatus <> 'O'"""
LOGS = """SELECT event_id, ts, 'job-' || user_id AS job_id,
       CASE event_type WHEN 'error' THEN 'stderr' WHEN 'view' THEN 'driver' WHEN 'purchase' THEN 'executor'
                       WHEN 'click' THEN 'stdout' END AS source,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' WHEN 'view' THEN 'INFO' END AS level,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' WHEN 'view' THEN 'INFO' ELSE 'NONE' END
         || ' ' || props AS message FROM events"""

@query("project_tax", f"SELECT *, {rounded('amount * 1.18::DOUBLE')} AS amount_tax FROM ({SALES})")
def project_tax(spark, d):
    return t.with_tax(fx.sales(spark, d), "amount")


@query(
    "project_product",
    f"SELECT l_orderkey, l_linenumber, {rounded(PRODUCT)} AS total_price FROM lineitem",
)
def project_product(spark, d):
    rows = fx.table(spark, d, "lineitem")
    return t.with_product(rows, "l_quantity", "l_extendedprice").select("l_orderkey", "l_linenumber", "total_price")


@query(
    "case_bucket",
    """SELECT event_id, value,
              CASE WHEN value < 50 THEN 'low' WHEN value < 200 THEN 'medium' ELSE 'high' END AS amount_bucket
       FROM events""",
)
def case_bucket(spark, d):
    return t.bucketize(fx.table(spark, d, "events", ["event_id", "value"]), "value")


@query("bool_flag", f"SELECT l_orderkey, l_linenumber, {PRODUCT} > 1000 AS is_high_value FROM lineitem")
def bool_flag(spark, d):
    rows = fx.table(spark, d, "lineitem")
    flagged = t.with_flag(rows, t.product("l_quantity", "l_extendedprice") > 1000, "is_high_value")
    return flagged.select("l_orderkey", "l_linenumber", "is_high_value")


# The time itself has no SQL twin; that all rows carry the time of this query has.
@query("stamp_processed_at", "SELECT event_id, true AS at_query_time FROM events")
def stamp_processed_at(spark, d):
    stamped = t.stamp(fx.table(spark, d, "events", ["event_id"]))
    return stamped.select("event_id", (F.col("processed_at") == F.current_timestamp()).alias("at_query_time"))


@query("filter_gt", "SELECT * FROM orders WHERE o_totalprice > 1000")
def filter_gt(spark, d):
    return t.where_gt(fx.table(spark, d, "orders"), "o_totalprice", 1000)


@query("filter_ne", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def filter_ne(spark, d):
    return t.where_ne(fx.table(spark, d, "orders"), "o_orderstatus", "P")


@query("selectivity_report", "SELECT count(*) FILTER (WHERE o_totalprice > 250000) AS matched, count(*) AS total FROM orders")
def selectivity_report(spark, d):
    return t.selectivity(fx.table(spark, d, "orders"), F.col("o_totalprice") > 250000)


@query("optional_filters", "SELECT * FROM events WHERE event_type = 'error' AND user_id = 7")
def optional_filters(spark, d):
    return t.where_all(fx.table(spark, d, "events"), event_type="error", user_id=7, props=None)


@query("label_match", f"SELECT * FROM ({LOGS}) WHERE job_id = 'job-7' AND source = 'stderr'")
def label_match(spark, d):
    return t.match_labels(fx.logs(spark, d), source="stderr", job_id="job-7")


@query("label_regex", f"SELECT * FROM ({LOGS}) WHERE regexp_full_match(source, 'std(out|err)|driver')")
def label_regex(spark, d):
    return t.match_regex(fx.logs(spark, d), "source", "std(out|err)|driver")


@query("line_contains", f"SELECT * FROM ({LOGS}) WHERE contains(message, 'ERROR')")
def line_contains(spark, d):
    return t.contains(fx.logs(spark, d), "message", "ERROR")


@query(
    "time_range",
    """SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'""",
)
def time_range(spark, d):
    return t.in_range(fx.table(spark, d, "events"), "ts", end=datetime(2024, 1, 15, 12))


@query(
    "name_rule",
    """SELECT c_name, false AS is_identifier,
              regexp_matches(lower(c_mktsegment), '^[a-z0-9][a-z0-9.-]*[a-z0-9]$')
                AND length(c_mktsegment) BETWEEN 3 AND 63 AS is_bucket_name,
              regexp_matches(c_mktsegment, '^[a-zA-Z_][a-zA-Z0-9_]*$') AS is_segment_identifier
       FROM customer""",
)
def name_rule(spark, d):
    rows = fx.table(spark, d, "customer").withColumn("bucket", F.lower("c_mktsegment"))
    rows = t.check_pattern(rows, "c_name", out="is_identifier")
    rows = t.check_pattern(rows, "bucket", t.BUCKET_NAME, *t.BUCKET_NAME_LENGTH, out="is_bucket_name")
    rows = t.check_pattern(rows, "c_mktsegment", out="is_segment_identifier")
    return rows.select("c_name", "is_identifier", "is_bucket_name", "is_segment_identifier")


@query("enum_rule", "SELECT o_orderkey, o_orderstatus, o_orderstatus IN ('F', 'O') AS is_valid FROM orders")
def enum_rule(spark, d):
    return t.check_enum(fx.table(spark, d, "orders", ["o_orderkey", "o_orderstatus"]), "o_orderstatus", ["F", "O"])


CUSTOMER_ORDERS = """SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_totalprice AS total,
                            c_name AS name, c_mktsegment AS tier, c_nationkey AS country
                     FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("join_inner", CUSTOMER_ORDERS)
def join_inner(spark, d):
    return j.join_inner(fx.customer_orders(spark, d), fx.customers(spark, d), "customer_id")


@query(
    "join_agg",
    f"""SELECT tier, country, count(*) AS orders, round(sum(total), 2) AS revenue
        FROM ({CUSTOMER_ORDERS}) GROUP BY tier, country""",
)
def join_agg(spark, d):
    orders = fx.customer_orders(spark, d).withColumn("total", money("total"))
    summary = j.join_summary(orders, fx.customers(spark, d), "customer_id", ["tier", "country"], "total")
    return summary.withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "parent_lookup",
    """SELECT c_nationkey AS nation, c_custkey, c_name, c_acctbal, c_mktsegment, n_name, n_regionkey
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE n_name = 'NATION_7' AND c_mktsegment = 'MACHINERY'""",
)
def parent_lookup(spark, d):
    parent = fx.table(spark, d, "nation").withColumnRenamed("n_nationkey", "nation")
    child = fx.table(spark, d, "customer").withColumnRenamed("c_nationkey", "nation")
    return j.lookup(child, parent, "nation", ("n_name", "NATION_7"), ("c_mktsegment", "MACHINERY"))


@query(
    "child_count",
    """SELECT c_custkey, c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS child_count
       FROM customer ORDER BY c_name""",
)
def child_count(spark, d):
    parent = fx.table(spark, d, "customer", ["c_custkey", "c_name"])
    child = fx.table(spark, d, "orders", ["o_custkey"]).withColumnRenamed("o_custkey", "c_custkey")
    return j.child_count(parent, child, "c_custkey").orderBy("c_name", "c_custkey")


# Sums in cents, so that they are exact; the average of a two-digit decimal has six digits.
@query(
    "agg_by_key",
    f"""SELECT category, n AS count, s::DOUBLE / 100 AS total_amount,
               ((2 * s * 10000 + n) // (2 * n))::DOUBLE / 1000000 AS avg_amount
        FROM (SELECT category, count(*) AS n, sum(CAST(round(amount * 100) AS BIGINT)) AS s FROM ({SALES}) GROUP BY ALL)""",
)
def agg_by_key(spark, d):
    exact = fx.sales(spark, d).withColumn("amount", money("amount"))
    totals = a.summarize(exact, ["category"], "amount")
    return totals.withColumns({c: F.col(c).cast("double") for c in ("total_amount", "avg_amount")})


SUMMARY = f"""SELECT category, country, count(*) AS count, round(sum(amount), 2) AS total_amount,
                     {rounded('avg(amount)')} AS avg_amount
              FROM ({SALES}) GROUP BY category, country"""


@query("agg_by_two_keys", SUMMARY)
def agg_by_two_keys(spark, d):
    return a.summarize(fx.sales(spark, d), ["category", "country"], "amount", digits=2)


@query(
    "distribution_stats",
    """SELECT event_type, count(*) AS n, round(avg(value), 2) AS mean, round(stddev_samp(value), 2) AS stddev,
              round(min(value), 2) AS min, round(max(value), 2) AS max FROM events GROUP BY event_type""",
)
def distribution_stats(spark, d):
    return a.distribution(fx.table(spark, d, "events"), "event_type", "value")


@query(
    "pivot_sum",
    """SELECT o_orderpriority,
              round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2) AS "F",
              round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS "O",
              round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS "P"
       FROM orders GROUP BY o_orderpriority""",
)
def pivot_sum(spark, d):
    orders = fx.table(spark, d, "orders").withColumn("o_totalprice", money("o_totalprice"))
    sums = a.pivot_sum(orders, "o_orderpriority", "o_orderstatus", "o_totalprice", ["F", "O", "P"])
    return sums.withColumns({c: F.col(c).cast("double") for c in ("F", "O", "P")})


@query("row_count", "SELECT count(*) AS count FROM lineitem")
def row_count(spark, d):
    return a.row_count(fx.table(spark, d, "lineitem"))


@query(
    "filtered_total",
    """SELECT *, (SELECT count(*) FROM events WHERE event_type = 'error') AS total FROM events
       WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 20 OFFSET 20""",
)
def filtered_total(spark, d):
    return a.filtered_total(fx.table(spark, d, "events"), ["ts", "event_id"], page=2, event_type="error")


@query(
    "dedup_report",
    """SELECT count(*) AS rows_before, count(DISTINCT o_custkey) AS rows_after,
              count(*) - count(DISTINCT o_custkey) AS rows_removed FROM orders""",
)
def dedup_report(spark, d):
    return a.dedup_report(fx.table(spark, d, "orders"), ["o_custkey"])


@query(
    "round2",
    f"""SELECT l_orderkey, l_linenumber,
              {rounded('l_extendedprice * l_discount')} AS cut FROM lineitem""",
)
def round_two(spark, d):
    rows = fx.table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"])
    return rows.select("l_orderkey", "l_linenumber", round2(F.col("l_extendedprice") * F.col("l_discount")).alias("cut"))


@query("dq_null_check", "SELECT count(*) FILTER (WHERE item IS NULL) AS null_item FROM (" + PREPARED + ")")
def dq_null_check(spark, d):
    return q.violations(prepare(fx.pipeline_orders(spark, d)), [q.expect_not_null("item")])


@query("dq_range_check", "SELECT count(*) FILTER (WHERE c_acctbal < 0) AS low_c_acctbal FROM customer")
def dq_range_check(spark, d):
    return q.violations(fx.table(spark, d, "customer"), [q.expect_min("c_acctbal", 0)])


@query("dq_gate", PREPARED)
def dq_gate(spark, d):
    return q.gate(prepare(fx.pipeline_orders(spark, d)), rules())


@query("sales_etl", SUMMARY)
def sales_load(spark, d):
    return sales_etl(fx.sales(spark, d), scratch_path(spark, "sales"), "2026-03-28")


@query("order_flow", PREPARED)
def order_flow_query(spark, d):
    return order_flow(fx.pipeline_orders(spark, d), scratch_path(spark, "orders"))
