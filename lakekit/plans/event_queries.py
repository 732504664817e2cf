"""Queries over events and orders: metrics, row order, pages, logs, schema, layout, lifecycle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakekit.functions import logs as lg
from lakekit.functions import scalars as sc
from lakekit.operators.ordered import Ordered
from lakekit.operators import layout as lo
from lakekit.operators import metrics as m
from lakekit.operators import paging as p
from lakekit.operators import schema as sch
from lakekit.operators import windows as w
from lakekit.operators.lifecycle import lifecycle
from lakekit.plans import fixtures as fx
from lakekit.plans.core_queries import LOGS, rounded
from lakekit.plans.log_query import query_logs
from lakekit.plans.registry import query
from lakekit.session import scratch_path
from lakekit.sources.scan import read_merged
from lakekit.sources.sinks import write

# ---- metrics ----

COUNTERS = """
    SELECT event_id, ts, 'service-' || right(user_id::VARCHAR, 1) AS job, event_type AS handler,
           CASE event_type WHEN 'error' THEN '5xx' WHEN 'signup' THEN '4xx' ELSE '2xx' END AS status,
           count(*) OVER (PARTITION BY right(user_id::VARCHAR, 1), event_type, ts::DATE ORDER BY ts, event_id) AS value
    FROM events"""
DELTAS = f"""
    SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS delta
    FROM (SELECT *, lag(value) OVER (PARTITION BY job, handler, status ORDER BY ts, event_id) AS p FROM ({COUNTERS}))"""


def _bucket(minutes: int, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', {ts})"


@query(
    "instant_latest",
    f"""SELECT event_id, ts, job, handler, status, value FROM (
          SELECT *, row_number() OVER (PARTITION BY job, handler, status ORDER BY ts DESC, event_id DESC) AS rn
          FROM ({COUNTERS})) WHERE rn = 1""",
)
def instant_latest(spark, d):
    return m.latest(fx.counters(spark, d), fx.COUNTER_SERIES, "ts", ["event_id"])


@query(
    "counter_increase",
    f"""SELECT {_bucket(15)} AS window_start, job, handler, status, CAST(sum(delta) AS BIGINT) AS increase
        FROM ({DELTAS}) GROUP BY ALL""",
)
def counter_increase(spark, d):
    return m.increase(fx.counters(spark, d), fx.COUNTER_SERIES, ["ts", "event_id"], "value")


@query(
    "counter_rate",
    f"SELECT {_bucket(1)} AS window_start, job, sum(delta) / 60.0::DOUBLE AS rate FROM ({DELTAS}) GROUP BY ALL",
)
def counter_rate(spark, d):
    return m.rate(fx.counters(spark, d), fx.COUNTER_SERIES, ["job"], ["ts", "event_id"], "value", "1 minute")


@query(
    "error_rate",
    f"""SELECT {_bucket(5)} AS window_start, job, sum(delta) / 300.0::DOUBLE AS rate FROM ({DELTAS})
        WHERE regexp_full_match(status, '4xx|5xx') GROUP BY ALL""",
)
def error_rate(spark, d):
    return m.error_rate(fx.counters(spark, d), fx.COUNTER_SERIES, ["job"], ["ts", "event_id"], "value")


@query(
    "activity_rates",
    f"""SELECT {_bucket(5)} AS window_start,
               coalesce(sum(delta) FILTER (WHERE handler = 'click'), 0) / 300.0::DOUBLE AS submissions,
               coalesce(sum(delta) FILTER (WHERE handler = 'purchase'), 0) / 300.0::DOUBLE AS callbacks,
               coalesce(sum(delta) FILTER (WHERE handler = 'view'), 0) / 300.0::DOUBLE AS log_fetches
        FROM ({DELTAS}) GROUP BY ALL""",
)
def activity_rates(spark, d):
    handler = F.col("handler")
    filters = {
        "submissions": handler == "click",
        "callbacks": handler == "purchase",
        "log_fetches": handler == "view",
    }
    return m.conditional_rates(fx.counters(spark, d), fx.COUNTER_SERIES, ["ts", "event_id"], "value", filters)


BOUNDS = [10, 25, 50, 100, 250]
HISTOGRAM, SAMPLED = (
    " UNION ALL ".join(
        f"""SELECT {_bucket(minutes)} AS window_start, event_type, '{b if b else '+Inf'}' AS le,
               count(*) FILTER (WHERE {f'value <= {b}' if b else 'value IS NOT NULL'}) AS cumulative
        FROM events GROUP BY ALL"""
        for b in [*BOUNDS, None]
    )
    for minutes in (5, 15)
)


@query("histogram_build", HISTOGRAM)
def histogram_build(spark, d):
    return m.histogram(fx.table(spark, d, "events"), ["event_type"], "ts", "value", BOUNDS)


@query(
    "histogram_quantile",
    f"""WITH c AS (SELECT *, sum(cumulative) OVER (PARTITION BY event_type, le, window_start::DATE ORDER BY window_start) AS value
                   FROM ({SAMPLED})),
             p AS (SELECT *, lag(value) OVER (PARTITION BY event_type, le ORDER BY window_start) AS p FROM c),
             d AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS delta FROM p),
             b AS (SELECT time_bucket(INTERVAL '1 hour', window_start) AS hour, event_type,
                          CASE WHEN le = '+Inf' THEN 1e308 ELSE le::DOUBLE END AS bound, sum(delta) AS raw FROM d GROUP BY ALL),
             m AS (SELECT *, max(raw) OVER (PARTITION BY hour, event_type ORDER BY bound) AS cum FROM b),
             r AS (SELECT *, lag(bound, 1, 0) OVER w AS low, lag(cum, 1, 0) OVER w AS under,
                          0.95 * max(cum) OVER (PARTITION BY hour, event_type) AS rank
                   FROM m WINDOW w AS (PARTITION BY hour, event_type ORDER BY bound)),
             h AS (SELECT *, row_number() OVER (PARTITION BY hour, event_type ORDER BY bound) AS n FROM r WHERE cum >= rank)
        SELECT hour AS window_start, event_type, round(CASE WHEN rank = 0 THEN NULL WHEN bound = 1e308 THEN low
                 ELSE low + (bound - low) * (rank - under) / (cum - under) END, 6) AS quantile FROM h WHERE n = 1""",
)
def histogram_quantile(spark, d):
    """p95 of each hour from bucket counters, sampled each quarter of an hour, that restart every day."""
    rows = m.histogram(fx.table(spark, d, "events"), ["event_type"], "ts", "value", BOUNDS, "15 minutes")
    daily = Ordered(rows.withColumn("day", F.to_date("window_start")), ["event_type", "le", "day"], ["window_start"])
    counters = daily.running(sums={"value": F.col("cumulative")}).result().withColumnRenamed("window_start", "ts")
    found = m.quantile_over_time(counters, 0.95, ["event_type"], ["event_type"], ["ts"], "value", width="1 hour")
    return found.withColumn("quantile", F.round("quantile", 6))


COUNT_OVER_TIME = f"SELECT {_bucket(15)} AS window_start, job_id, count(*) AS count FROM ({LOGS}) GROUP BY ALL"


@query("count_over_time", COUNT_OVER_TIME)
def count_over_time(spark, d):
    return m.count_over_time(fx.logs(spark, d), ["job_id"], "ts")


# ---- row order ----


@query(
    "moving_average",
    f"""SELECT event_id, user_id, ts, value, {rounded(
        "CASE WHEN b IS NOT NULL THEN (b + a + value) / 3 WHEN a IS NOT NULL THEN (a + value) / 2 ELSE value END"
    )} AS moving_avg FROM (SELECT *, lag(value) OVER w AS a, lag(value, 2) OVER w AS b FROM events
                          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
)
def moving_average(spark, d):
    rows = fx.table(spark, d, "events", ["event_id", "user_id", "ts", "value"])
    return w.moving_avg(rows, "user_id", ["ts", "event_id"], "value")


@query(
    "latest_per_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events) WHERE rn = 1""",
)
def latest_per_key(spark, d):
    return w.latest_row(fx.table(spark, d, "events"), ["user_id"], "ts", ["event_id"])


@query(
    "schema_versioning",
    "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM events",
)
def schema_versioning(spark, d):
    rows = fx.table(spark, d, "events", ["user_id", "event_id", "ts"])
    return w.number_versions(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


# ---- sorting, pages, top groups, deduplication ----


@query("sort_by_name", "SELECT * FROM customer ORDER BY c_name, c_custkey")
def sort_by_name(spark, d):
    return p.sort_by(fx.table(spark, d, "customer"), "c_name", "c_custkey")


@query("newest_first", "SELECT * FROM events ORDER BY ts DESC, event_id DESC")
def newest_first(spark, d):
    return p.newest_first(fx.table(spark, d, "events"), "ts", "event_id")


@query("offset_page", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 20 OFFSET 40")
def offset_page(spark, d):
    return p.page_of(fx.table(spark, d, "events"), ["ts", "event_id"], page=3)


@query("tail_n", f"SELECT * FROM ({LOGS}) ORDER BY ts DESC, event_id DESC LIMIT 500")
def tail_n(spark, d):
    return p.tail(fx.logs(spark, d), "ts", 500, ["event_id"])


@query(
    "keyset_page",
    """WITH ahead AS (SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 1001),
            kept AS (SELECT * FROM ahead ORDER BY o_orderkey LIMIT 1000)
       SELECT *, (SELECT count(*) FROM ahead) > 1000 AS is_truncated,
              CASE WHEN (SELECT count(*) FROM ahead) > 1000 THEN (SELECT max(o_orderkey) FROM kept) END AS next_token
       FROM kept""",
)
def keyset_page(spark, d):
    return p.keyset(fx.table(spark, d, "orders"), "o_orderkey", after=1000, size=1000)


@query(
    "topk_groups",
    f"""SELECT job, handler, status, CAST(sum(delta) AS BIGINT) AS total FROM ({DELTAS}) GROUP BY ALL
        ORDER BY total DESC, job, handler, status LIMIT 12""",
)
def topk_groups(spark, d):
    grown = m.deltas(fx.counters(spark, d), fx.COUNTER_SERIES, ["ts", "event_id"], "value")
    return p.topk_groups(grown, fx.COUNTER_SERIES, F.sum("delta"), 12)


@query(
    "topk_per_window",
    f"""SELECT window_start, job_id, count FROM (
          SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, job_id) AS rn
          FROM ({COUNT_OVER_TIME})) WHERE rn <= 10""",
)
def topk_per_window(spark, d):
    counts = m.count_over_time(fx.logs(spark, d), ["job_id"], "ts")
    return p.topk_per(counts, ["window_start"], "count", 10, ["job_id"])


@query(
    "dedup_by_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def dedup_by_key(spark, d):
    return p.dedup(fx.table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"])


@query(
    "idempotent_events",
    """SELECT job_id, retry_count, ts, event_id FROM (
         SELECT *, row_number() OVER (PARTITION BY job_id, retry_count ORDER BY ts, event_id) AS rn FROM (
           SELECT 'job-' || user_id AS job_id, CAST(floor(value / 100) AS INT) AS retry_count, ts, event_id FROM events))
       WHERE rn = 1""",
)
def idempotent_events(spark, d):
    rows = fx.table(spark, d, "events").select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        F.floor(F.col("value") / 100).cast("int").alias("retry_count"),
        "ts",
        "event_id",
    )
    return p.dedup_events(rows, "ts", "event_id")


# ---- logs and scalars ----

LINES = """SELECT CASE WHEN event_type = 'signup' THEN 'raw ' || event_id || ' ' || props
                  ELSE '[' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '] [' || upper(event_type) || '] '
                       || event_id || ' ' || props END AS line FROM events"""
PARSED = rf"""
    SELECT line,
           CASE WHEN hit THEN strptime(regexp_extract(line, '^\[([^\]]+)\] \[([^\]]+)\] (.*)$', 1), '%Y-%m-%dT%H:%M:%SZ') END AS ts,
           CASE WHEN hit THEN regexp_extract(line, '^\[([^\]]+)\] \[([^\]]+)\] (.*)$', 2) END AS level,
           CASE WHEN hit THEN regexp_extract(line, '^\[([^\]]+)\] \[([^\]]+)\] (.*)$', 3) ELSE line END AS message
    FROM (SELECT line, regexp_matches(line, '^\[([^\]]+)\] \[([^\]]+)\] (.*)$') AS hit FROM ({LINES}))"""


@query("parse_log_line", PARSED)
def parse_log_line(spark, d):
    return lg.parse_log(fx.log_lines(spark, d)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("enrich_labels", "SELECT event_id, 'job-' || user_id AS job_id, 'pod-1' AS container_id, 'driver' AS source FROM events")
def enrich_labels(spark, d):
    rows = fx.logs(spark, d).select("event_id", "job_id")
    return lg.add_labels(rows, job_id=F.col("job_id"), container_id="pod-1")


@query(
    "log_query",
    f"""SELECT event_id, ts, job_id, coalesce(source, 'unknown') AS source, coalesce(level, 'INFO') AS level, message
        FROM ({LOGS}) WHERE job_id = 'job-7' AND ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
        ORDER BY ts DESC, event_id DESC LIMIT 50""",
)
def log_query(spark, d):
    return query_logs(fx.logs(spark, d), "job-7", n=50, start=datetime(2024, 1, 2), end=datetime(2024, 1, 20), ties=["event_id"])


@query(
    "default_labels",
    f"SELECT * REPLACE (coalesce(source, 'unknown') AS source, coalesce(level, 'INFO') AS level) FROM ({LOGS})",
)
def default_labels(spark, d):
    return lg.default_labels(fx.logs(spark, d))


@query(
    "ns_to_timestamp",
    "SELECT event_id, epoch_us(ts) * 1000 AS ns, make_timestamp(epoch_us(ts)) AS back FROM events",
)
def ns_to_timestamp(spark, d):
    rows = fx.table(spark, d, "events", ["event_id", "ts"]).select("event_id", lg.ts_to_ns("ts").alias("ns"))
    return rows.withColumn("back", lg.ns_to_ts("ns").cast("timestamp_ntz"))


@query(
    "format_log",
    """SELECT event_id, '[' || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '] [' || event_type || '] ' || props AS line
       FROM events""",
)
def format_log(spark, d):
    rows = fx.table(spark, d, "events")
    return rows.select("event_id", lg.format_log("ts", "event_type", "props").alias("line"))


@query(
    "attempt_name",
    """SELECT event_id, 'spark-job-' || substr('job-' || lpad(event_id::VARCHAR, 12, '0'), 1, 8) || '-r'
              || CAST(floor(value / 100) AS INT) AS name FROM events""",
)
def attempt_name(spark, d):
    job = F.concat(F.lit("job-"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    rows = fx.table(spark, d, "events", ["event_id", "value"])
    return rows.select("event_id", sc.attempt_name(job, F.floor(F.col("value") / 100)).alias("name"))


@query(
    "table_location",
    """SELECT c_custkey, 's3a://warehouse/' || lower(c_mktsegment) || '/customer_' || c_custkey || '/' AS location
       FROM customer""",
)
def table_location(spark, d):
    table = F.concat(F.lit("customer_"), F.col("c_custkey").cast("string"))
    place = sc.table_location("s3://warehouse/", F.lower("c_mktsegment"), table)
    return fx.table(spark, d, "customer").select("c_custkey", sc.to_s3a(place).alias("location"))


@query(
    "map_merge",
    """SELECT event_id, 'k=' || json_extract_string(props, '$.k') || ',kind=' || event_type || ',user=' || user_id AS merged
       FROM events""",
)
def map_merge(spark, d):
    left = F.create_map(F.lit("kind"), F.lit("none"), F.lit("user"), F.col("user_id").cast("string"))
    right = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("k"), sc.json_field("props", "$.k"))
    pairs = F.transform(F.map_entries(sc.map_merge(left, right)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    rows = fx.table(spark, d, "events")
    return rows.select("event_id", F.array_join(F.array_sort(pairs), ",").alias("merged"))


def _names(fields):
    return F.array_join(F.transform(fields, lambda f: f["name"]), ",")


EDITED = """CASE event_type WHEN 'signup' THEN 'id,amount,c' || json_extract_string(props, '$.k')
                            WHEN 'click' THEN 'id,total,c' || json_extract_string(props, '$.k')
                            ELSE 'id,amount' END"""
TEXTS = """CASE event_type WHEN 'signup' THEN 'Added column: c' || json_extract_string(props, '$.k') || ' (string)'
                           WHEN 'click' THEN 'Added column: c' || json_extract_string(props, '$.k')
                                             || ' (string); Renamed column: amount -> total'
                           WHEN 'purchase' THEN 'Dropped column: old_column' ELSE '' END"""


@query("array_edit", f"SELECT event_id, {EDITED} AS names FROM events")
def array_edit(spark, d):
    edited = sc.edit_fields("fields", "add", "drop", "rename")
    return fx.schema_changes(spark, d).select("event_id", _names(edited).alias("names"))


@query("change_summary", f"SELECT event_id, {TEXTS} AS change_summary FROM events")
def change_summary(spark, d):
    texts = sc.change_texts("fields", "add", "drop", "rename")
    return fx.schema_changes(spark, d).select("event_id", sc.join_changes(texts).alias("change_summary"))


@query(
    "json_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
              json_extract_string(props, '$.missing') AS missing FROM events""",
)
def json_extract(spark, d):
    rows = fx.table(spark, d, "events", ["event_id", "props"])
    return rows.select(
        "event_id", sc.json_field("props", "$.k", "int").alias("k"), sc.json_field("props", "$.missing").alias("missing")
    )


# ---- schema, layout, snapshots ----

HISTORY = f"""
    SELECT user_id AS table_id, ts, event_id,
           1 + row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version,
           {EDITED} AS fields, {TEXTS} AS change_summary, 'user-' || json_extract_string(props, '$.k') AS changed_by
    FROM events WHERE event_type IN ('signup', 'click', 'purchase')"""


@query(
    "schema_history",
    """
    WITH RECURSIVE e AS (
      SELECT user_id AS table_id, ts, event_id, event_type AS kind, 'c' || CAST(json_extract_string(props, '$.k') AS INT) % 10 AS c,
             'c' || (CAST(json_extract_string(props, '$.k') AS INT) % 10 + 1) % 10 AS onward,
             'user-' || CAST(json_extract_string(props, '$.k') AS INT) % 10 AS changed_by,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
      FROM events WHERE event_type IN ('signup', 'click', 'purchase', 'error')),
    s AS (
      SELECT DISTINCT table_id, CAST(0 AS BIGINT) AS n, ['id', 'amount'] AS names, CAST(1 AS BIGINT) AS version,
             CAST('' AS VARCHAR) AS change_summary FROM e
      UNION ALL
      SELECT t.table_id, t.n,
             CASE t.kind WHEN 'signup' THEN list_append(names, c) WHEN 'purchase' THEN list_filter(names, lambda x: x <> c)
               ELSE CASE WHEN place IS NULL THEN names ELSE list_concat(names[1:place - 1], [new], names[place + 1:]) END END,
             version + CASE WHEN t.kind IN ('signup', 'purchase') OR place IS NOT NULL THEN 1 ELSE 0 END,
             CASE t.kind WHEN 'signup' THEN 'Added column: ' || c || ' (string)' WHEN 'purchase' THEN 'Dropped column: ' || c
               ELSE CASE WHEN place IS NULL THEN '' ELSE 'Renamed column: ' || old || ' -> ' || new END END
      FROM (SELECT e.*, s.names, s.version, CASE e.kind WHEN 'click' THEN e.c ELSE 'amount' END AS old,
                   CASE e.kind WHEN 'click' THEN e.onward ELSE e.c END AS new,
                   list_position(s.names, CASE e.kind WHEN 'click' THEN e.c ELSE 'amount' END) AS place
            FROM s JOIN e ON e.table_id = s.table_id AND e.n = s.n + 1) t)
    SELECT e.table_id, e.ts, e.event_id, s.version, array_to_string(s.names, ',') AS fields, s.change_summary, e.changed_by
    FROM s JOIN e USING (table_id, n) WHERE s.change_summary <> ''
    """,
)
def schema_history(spark, d):
    start = [sch.Field("id", "long"), sch.Field("amount", "decimal")]
    rows = sch.accumulate(fx.schema_log(spark, d), "table_id", ["ts", "event_id"], start)
    return rows.withColumn("fields", _names(F.col("fields")))


@query(
    "next_version",
    f"""SELECT c_custkey, 1 + coalesce((SELECT max(version) FROM ({HISTORY}) WHERE table_id = c_custkey), 0) AS next_version
        FROM customer""",
)
def next_version(spark, d):
    rows = sch.history(fx.schema_changes(spark, d), "table_id", ["ts", "event_id"])
    tables = fx.table(spark, d, "customer", ["c_custkey"])
    return w.next_version(rows.withColumnRenamed("table_id", "c_custkey"), tables, "c_custkey")


@query("apply_schema", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_totalprice > 250000 AS is_large FROM orders")
def apply_schema(spark, d):
    text = fx.table(spark, d, "orders").select(
        *[F.col(c).cast("string") for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")],
        (F.col("o_totalprice") > 250000).cast("string").alias("is_large"),
    )
    fields = [
        sch.Field("o_orderkey", "long", nullable=False, description="order id"),
        sch.Field("o_orderstatus", "string"),
        sch.Field("o_totalprice", "decimal"),
        sch.Field("o_orderdate", "timestamp"),
        sch.Field("is_large", "boolean"),
    ]
    typed = sch.apply_schema(text, fields)
    return typed.withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("double"), "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")}
    )


@query(
    "evolve_schema",
    """SELECT o_orderkey, o_custkey, o_totalprice AS total, o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS region
       FROM orders""",
)
def evolve_schema(spark, d):
    return sch.evolve(
        fx.table(spark, d, "orders"),
        add=[sch.Field("region", "string"), sch.Field("brief", "int")],
        drop=["o_orderstatus", "brief", "old_column"],
        rename={"o_totalprice": "total", "old_name": "new_name"},
    )


@query(
    "read_mixed_schema",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END
              AS o_orderpriority FROM orders""",
)
def read_mixed_schema(spark, d):
    orders, path = fx.table(spark, d, "orders"), scratch_path(spark, "mixed")
    old = F.col("o_orderdate") < "1998-01-01"
    write(orders.filter(old).select("o_orderkey", "o_totalprice"), path, "append")
    write(orders.filter(~old).select("o_orderkey", "o_totalprice", "o_orderpriority"), path, "append")
    return read_merged(spark, path)


@query("partition_transform", "SELECT *, strftime(ts, '%Y-%m-%d') AS ts_day FROM events")
def partition_transform(spark, d):
    events, path = fx.table(spark, d, "events"), scratch_path(spark, "days")
    lo.write_partitioned(events, path, [{"field": "ts", "transform": "day"}])
    stored = spark.read.schema(f"{_ddl(events)}, ts_day date").parquet(path)
    return stored.withColumn("ts_day", F.col("ts_day").cast("string"))


def _ddl(df) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


@query("sort_order_write", "SELECT * FROM orders")
def sort_order_write(spark, d):
    orders, path = fx.table(spark, d, "orders"), scratch_path(spark, "sorted")
    lo.write_sorted(orders, path, [{"field": "o_orderdate", "direction": "desc"}])
    return spark.read.schema(orders.schema).parquet(path)


def _snapshot_log(orders):
    """One snapshot for each order month; the first month of a year starts the table anew."""
    month = F.date_format("o_orderdate", "yyyyMM").cast("long")
    operation = F.when(F.col("snapshot_id").cast("string").endswith("01"), "overwrite").otherwise("append")
    return (
        orders.groupBy(F.col("o_orderpriority").alias("table_id"), month.alias("snapshot_id"))
        .agg(F.max("o_orderdate").alias("created_at"))
        .withColumn("operation", operation)
    )


SNAPSHOTS = """SELECT o_orderpriority AS table_id, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS snapshot_id,
                      max(o_orderdate) AS created_at FROM orders GROUP BY ALL"""


@query(
    "snapshot_log",
    f"""SELECT *, CASE WHEN right(snapshot_id::VARCHAR, 2) = '01' THEN 'overwrite' ELSE 'append' END AS operation,
               CAST(lag(snapshot_id) OVER (PARTITION BY table_id ORDER BY created_at, snapshot_id) AS VARCHAR) AS parent_id
        FROM ({SNAPSHOTS})""",
)
def snapshot_log(spark, d):
    log = _snapshot_log(fx.table(spark, d, "orders"))
    chained = lo.snapshots(log, "table_id", ["created_at", "snapshot_id"])
    return chained.withColumn("parent_id", F.col("parent_id").cast("string"))


@query(
    "read_as_of",
    """SELECT *, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS snapshot_id FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-06-01'""",
)
def read_as_of(spark, d):
    orders = fx.table(spark, d, "orders")
    log = _snapshot_log(orders.withColumn("o_orderpriority", F.lit("orders")))
    data = orders.withColumn("snapshot_id", F.date_format("o_orderdate", "yyyyMM").cast("long"))
    path = scratch_path(spark, "snapshots")
    write(data, path, partition_by=["snapshot_id"])
    return lo.read_as_of(spark, path, data.schema, log, 199805)


# ---- job lifecycle ----

JOB_EVENTS = """
    SELECT 'job-' || user_id AS job_id, event_id, ts, is_cancel,
           CASE WHEN NOT is_cancel THEN CASE event_type WHEN 'signup' THEN 'QUEUED' WHEN 'click' THEN 'PROVISIONING'
             WHEN 'view' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCESS' ELSE 'FAILED' END END AS status,
           CASE WHEN NOT is_cancel AND event_type = 'error' THEN 'failed at ' || event_id END AS error_message,
           CAST(user_id % 4 AS INT) AS max_retries,
           CASE WHEN NOT is_cancel AND event_type IN ('view', 'purchase') THEN 'pod-' || event_id ELSE '' END AS pod
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) < 10 AS is_cancel FROM events)"""
LIFECYCLE = f"""
    WITH r AS (
      SELECT *, sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) OVER w AS cf,
             last_value(status IGNORE NULLS) OVER w AS seen,
             coalesce(lag(is_cancel) OVER (PARTITION BY job_id ORDER BY ts, event_id), false) AS after_cancel
      FROM ({JOB_EVENTS})
      WINDOW w AS (PARTITION BY job_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    s AS (
      SELECT *, coalesce(CASE WHEN seen <> 'FAILED' THEN seen WHEN cf <= max_retries THEN 'QUEUED' WHEN cf > max_retries THEN 'DEAD' END,
                         'PENDING') AS resting FROM r),
    c AS (
      SELECT *, CASE WHEN is_cancel AND resting NOT IN ('SUCCESS', 'DEAD', 'CANCELLED') THEN 'CANCELLED'
                     ELSE resting END AS status_after,
             CASE WHEN is_cancel THEN NOT after_cancel AND resting NOT IN ('SUCCESS', 'DEAD', 'CANCELLED')
                  ELSE status IN ('SUCCESS', 'FAILED', 'CANCELLED', 'DEAD') END AS completes FROM s)
    SELECT job_id, ts, event_id, status_after, CAST(least(cf, max_retries) AS BIGINT) AS retry_count, max_retries,
           last_value(CASE WHEN status = 'RUNNING' THEN ts END IGNORE NULLS) OVER w AS started_at,
           last_value(CASE WHEN completes THEN ts END IGNORE NULLS) OVER w AS completed_at,
           last_value(error_message IGNORE NULLS) OVER w AS last_error,
           last_value(CASE WHEN pod <> '' THEN pod END IGNORE NULLS) OVER w AS container_id
    FROM c WINDOW w AS (PARTITION BY job_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


def plain_times(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "started_at", "completed_at")})


@query("job_lifecycle", LIFECYCLE)
def job_lifecycle(spark, d):
    return plain_times(lifecycle(fx.job_events(fx.table(spark, d, "events"))))
