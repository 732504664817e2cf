"""Queries that run as streams to the end of their input and return what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.operators.windows import first_rows
from lakekit.plans import fixtures as fx
from lakekit.plans.core_queries import LOGS
from lakekit.plans.event_queries import DELTAS, LIFECYCLE, PARSED, plain_times
from lakekit.plans.registry import query
from lakekit.session import scratch_path
from lakekit.streaming import streams as st
from lakekit.streaming.lifecycle_stream import newest_states, run_lifecycle

def _events(spark, d):
    """The events as a stream; event-time windows need the timestamp type.

    A stream takes a folder or a pattern, and this pattern fits both one file and a folder of files.
    """
    source = st.file_stream(spark, f"{d.rstrip('/')}/{{events}}.parquet", fx.event_schema(spark, d))
    return source.withColumn("ts", F.col("ts").cast("timestamp"))


def _stored(spark, path, schema):
    return spark.read.schema(schema).parquet(path).drop("batch")


def _out(spark, label):
    return scratch_path(spark, label), scratch_path(spark, label + "-checkpoint")


@query(
    "stream_log_ingest",
    f"SELECT *, 'driver' AS source, 'job-1' AS job_id, 'pod-1' AS container_id FROM ({PARSED})",
)
def stream_log_ingest(spark, d):
    lines = scratch_path(spark, "log-files")
    fx.log_lines(spark, d).write.text(lines)
    out, checkpoint = _out(spark, "log-table")
    st.ingest_logs(spark, lines, out, checkpoint, {"job_id": "job-1", "container_id": "pod-1"}, glob="*.txt")
    stored = _stored(
        spark, out, "line string, ts timestamp, level string, message string, source string, job_id string, container_id string"
    )
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_incremental_tail", f"SELECT event_id, ts, job_id, source, message FROM ({LOGS})")
def stream_incremental_tail(spark, d):
    """Every line once, though each arrives twice, at any distance and in any order of files."""
    logs = fx.log_rows(_events(spark, d)).select("event_id", "ts", "job_id", "source", "message")
    out, checkpoint = _out(spark, "tail")
    st.run_parts(logs.union(logs), out, checkpoint, lambda batch: first_rows(batch, ["event_id"], [F.asc("ts")]))
    shown = first_rows(st.read_parts(spark, out), ["event_id"], [F.asc("batch"), F.asc("ts")]).drop("batch")
    return shown.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_count_over_time",
    """SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start, user_id, count(*) AS count
       FROM events GROUP BY ALL""",
)
def stream_count_over_time(spark, d):
    out, checkpoint = _out(spark, "counts")
    st.run_parts(_events(spark, d), out, checkpoint, lambda b: st.windowed_counts(b, ["user_id"], "ts", "15 minutes"))
    counts = st.read_parts(spark, out).groupBy("window_start", "user_id").agg(F.sum("count").alias("count"))
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "stream_sliding_rate",
    f"""SELECT w AS window_start, job, sum(delta) / 300.0::DOUBLE AS rate
        FROM (SELECT job, delta, time_bucket(INTERVAL '1 minute', ts) - to_minutes(unnest([0, 1, 2, 3, 4])) AS w FROM ({DELTAS}))
        GROUP BY ALL""",
)
def stream_sliding_rate(spark, d):
    """Counters that restart every day, streamed from files that hold their samples in any order."""
    samples = scratch_path(spark, "counter-samples")
    counters = fx.counters(spark, d)
    counters.write.parquet(samples)
    out, checkpoint = _out(spark, "rates")
    panes = lambda batch: st.pane_samples(batch, fx.COUNTER_SERIES, ["ts", "event_id"], "value")
    st.run_parts(st.file_stream(spark, samples, counters.schema), out, checkpoint, panes)
    return st.counter_rates(st.read_parts(spark, out), fx.COUNTER_SERIES, ["job"])


@query(
    "stream_job_lifecycle",
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, event_id DESC) AS rn FROM ({LIFECYCLE}))
        WHERE rn = 1""",
)
def stream_job_lifecycle(spark, d):
    out, checkpoint = _out(spark, "lifecycle")
    run_lifecycle(fx.job_events(_events(spark, d)), out, checkpoint)
    return plain_times(newest_states(st.read_parts(spark, out)))


@query(
    "stream_cancellations",
    """SELECT 'job-' || user_id AS job_id, 'cancel' AS action, event_id FROM events WHERE event_type = 'error'""",
)
def stream_cancellations(spark, d):
    action = F.when(F.col("event_type") == "error", "cancel").otherwise("status")
    job = F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id")
    messages = _events(spark, d).select(F.to_json(F.struct(job, action.alias("action"), "event_id")).alias("value"))
    cancels = st.cancellations(messages, "job_id string, action string, event_id bigint")
    out, checkpoint = _out(spark, "cancels")
    st.run_available(cancels, out, checkpoint)
    return _stored(spark, out, cancels.schema)


@query(
    "stream_idempotent_events",
    """SELECT 'job-' || user_id AS job_id, CAST(floor(value / 100) AS INT) AS retry_count, min(ts) AS ts
       FROM events GROUP BY ALL""",
)
def stream_idempotent_events(spark, d):
    """Each attempt once, at its earliest time, in whatever order the files bring it."""
    attempts = _events(spark, d).select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        F.floor(F.col("value") / 100).cast("int").alias("retry_count"),
        "ts",
    )
    out, checkpoint = _out(spark, "accepted")
    first = lambda rows: rows.groupBy("job_id", "retry_count").agg(F.min("ts").alias("ts"))
    st.run_parts(attempts, out, checkpoint, first)
    return first(st.read_parts(spark, out)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
