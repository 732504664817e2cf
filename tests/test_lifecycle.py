"""The closed form, and the stream, against a fold over single events."""

import random

import pytest
from pyspark.sql import functions as F

from lakekit.operators.lifecycle import COMPLETING, TERMINAL, final_states, lifecycle
from lakekit.operators.windows import first_rows
from lakekit.streaming import streams as st
from lakekit.streaming.lifecycle_stream import newest_states, run_lifecycle

SCHEMA = "job_id string, event_id long, ts timestamp, status string, is_cancel boolean, error_message string"
ACTIONS = ["QUEUED", "PROVISIONING", "RUNNING", "SUCCESS", "FAILED", "FAILED", "CANCELLED", "DEAD", None, None]


def make_events(seed, jobs=12, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        status = rng.choice(ACTIONS)
        error = rng.choice([None, "", f"e{i}"]) if status else None
        job = "hot" if i % 3 == 0 else f"job{rng.randint(0, jobs)}"
        out.append((job, i, 1_700_000_000 + i // 2, status, status is None, error))
    return out


def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA.replace("ts timestamp", "ts long")).withColumn(
        "ts", F.timestamp_seconds("ts")
    )


def fold(events, max_retries, guard):
    state, out = {}, {}
    for job, event_id, ts, status, cancel, error in sorted(events, key=lambda e: (e[2], e[1])):
        s = state.setdefault(job, {"status": "PENDING", "failures": 0, "start": None, "end": None, "error": None})
        closed = s["status"] in TERMINAL
        if cancel:
            if not closed:
                s["status"], s["end"] = "CANCELLED", ts
        elif not (guard and closed):
            s["status"] = status
            s["error"] = error or s["error"]
            if status == "RUNNING":
                s["start"] = ts
            if status in COMPLETING:
                s["end"] = ts
            if status == "FAILED":
                s["failures"] += 1
                s["status"] = "QUEUED" if s["failures"] <= max_retries else "DEAD"
        retries = min(s["failures"], max_retries)
        out[job, event_id] = (s["status"], retries, s["start"], s["end"], s["error"])
    return out


def states(df):
    seconds = [F.unix_seconds(c).alias(c) for c in ("started_at", "completed_at")]
    picked = df.select("job_id", "event_id", "status_after", "retry_count", *seconds, "last_error")
    return {(r[0], r[1]): tuple(r[2:]) for r in picked.collect()}


@pytest.mark.parametrize("guard", [False, True])
@pytest.mark.parametrize("seed,max_retries,run_rows", [(1, 3, None), (2, 1, 10), (3, 0, 25)])
def test_matches_fold(spark, seed, max_retries, run_rows, guard):
    events = make_events(seed)
    got = states(lifecycle(frame(spark, events), max_retries, guard, run_rows))
    assert got == fold(events, max_retries, guard)


def in_four_files(spark, path, events):
    whole = frame(spark, events)
    for i in range(4):
        part = whole.filter(F.col("event_id").between(i * 100, i * 100 + 99))
        part.coalesce(1).write.mode("append").parquet(path)
    return whole


@pytest.mark.parametrize("guard", [False, True])
@pytest.mark.parametrize("files", [4, 12])
def test_state_table_after_each_batch(spark, tmp_path, guard, files):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = make_events(8)
    whole, size = frame(spark, events), -(-len(events) // files)
    for i in range(files):
        part = whole.filter(F.col("event_id").between(i * size, i * size + size - 1))
        part.coalesce(1).write.mode("append").parquet(source)
    run_lifecycle(st.file_stream(spark, source, whole.schema, max_bytes=1), out, str(tmp_path / "ck"), 1, guard)
    versions = st.read_parts(spark, out)
    for batch in range(0, files, 3):
        seen = whole.filter(F.col("event_id") < (batch + 1) * size)
        got = states(newest_states(versions.filter(F.col("batch") <= batch)))
        assert got == states(final_states(seen, 1, guard))
    # A micro-batch writes the jobs it changes and no others.
    last = whole.filter(F.col("event_id") >= (files - 1) * size).select("job_id").distinct().count()
    assert versions.filter(F.col("batch") == files - 1).count() == last


def test_failures_beyond_the_limit(spark):
    events = [("a", i, 1_700_000_000 + i, "FAILED", False, "") for i in range(5)]
    got = states(lifecycle(frame(spark, events)))
    assert [got["a", i][0] for i in range(5)] == ["QUEUED"] * 3 + ["DEAD"] * 2
    assert [got["a", i][1] for i in range(5)] == [1, 2, 3, 3, 3]
