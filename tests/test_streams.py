"""Streams: equality with batch, late rows, restarts."""

import pytest
from pyspark.sql import functions as F

from lakekit.operators.metrics import count_over_time
from lakekit.streaming import streams as st


def parts(spark, path, batches, schema="k string, sec long"):
    """One file for each batch of (key, second)."""
    for batch in batches:
        df = spark.createDataFrame(batch, schema).withColumn("ts", F.timestamp_seconds("sec"))
        df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def stream(spark, path, schema):
    return st.file_stream(spark, path, schema, max_bytes=1)


def test_complete_counts_equal_batch(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    schema = parts(spark, path, [[(f"k{i % 4}", i * 97 + b * 3000) for i in range(40)] for b in range(3)])
    counts = st.count_over_time_stream(stream(spark, path, schema), ["k"], "ts", delay="10 days")
    st.run_batches(counts, str(tmp_path / "out"), str(tmp_path / "ck"), mode="complete")
    last = spark.read.parquet(str(tmp_path / "out")).filter("batch = 2").drop("batch")
    assert rows(last) == rows(count_over_time(spark.read.parquet(path), ["k"], "ts"))


def test_late_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    # A batch drops rows behind the watermark that the batch before it started with.
    schema = parts(spark, path, [[("a", 5), ("a", 10)], [("a", 7200)], [("a", 7201)], [("a", 20)], [("a", 99_000)]])
    counts = st.count_over_time_stream(stream(spark, path, schema), ["k"], "ts", "15 minutes", "10 minutes")
    st.run_available(counts, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r["window_start"].timestamp(): r["count"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[0] == 2 and got[7200] == 2


def test_tail_shows_each_line_once_in_order(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = parts(spark, path, [[("b", 5), ("a", 5), ("c", 1)], [("c", 1), ("d", 9)]])
    shown = st.tail_stream(stream(spark, path, schema), "ts", "k")
    out = str(tmp_path / "out")
    st.run_batches(shown, out, str(tmp_path / "ck"), ["ts", "k"])
    got = [[r["k"] for r in spark.read.parquet(f"{out}/batch={b}").orderBy("ts", "k").collect()] for b in (0, 1)]
    assert got == [["c", "a", "b"], ["d"]]


def test_restart_adds_only_new_files(spark, tmp_path):
    path, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for value in ("one", "two"):
        spark.createDataFrame([(f"[2024-01-01T00:00:00Z] [INFO] {value}",)], "line string").write.mode("append").text(path)
        st.ingest_logs(spark, path, out, ck, {"job_id": "j"}, glob="*.txt")
    got = spark.read.parquet(out)
    assert sorted(r["message"] for r in got.collect()) == ["one", "two"]
    assert {r["source"] for r in got.collect()} == {"driver"}


def test_sliding_rate(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = parts(spark, path, [[("a", 600 + i) for i in range(30)], [("z", 90_000)]])
    rates = st.sliding_rate(stream(spark, path, schema), ["k"], "ts", "5 minutes", "1 minute", "1 minute")
    st.run_available(rates, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = [r for r in spark.read.parquet(str(tmp_path / "out")).collect() if r["k"] == "a"]
    assert [r["rate"] for r in got] == [pytest.approx(0.1)] * 5


@pytest.mark.parametrize("files,run_rows", [(1, None), (12, None), (12, 5)])
def test_counter_rates_equal_batch_growth(spark, tmp_path, files, run_rows):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    # The counter of each series restarts every 50 samples, and each file holds every n-th sample.
    samples = [(f"k{i % 3}", i * 17, (i // 3) % 50 * (1 + i % 3)) for i in range(360)]
    schema = parts(spark, path, [samples[f::files] for f in range(files)], "k string, sec long, value long")
    panes = lambda batch: st.pane_samples(batch, ["k"], ["ts", "sec"], "value")
    st.run_parts(stream(spark, path, schema), out, str(tmp_path / "ck"), panes)
    stored = st.read_parts(spark, out)
    assert stored.select("batch").distinct().count() == files
    rates = st.counter_rates(stored, ["k"], ["k"], run_rows=run_rows)
    want = {}
    for key in ("k0", "k1", "k2"):
        before = None
        for _, sec, value in [s for s in samples if s[0] == key]:
            grown = 0 if before is None else value if value < before else value - before
            before = value
            for back in range(5):
                start = sec // 60 * 60 - back * 60
                want[key, start] = want.get((key, start), 0) + grown
    got = {(r["k"], int(r["window_start"].timestamp())): r["rate"] for r in rates.collect()}
    assert got == {at: pytest.approx(grown / 300) for at, grown in want.items()}


def test_attempts_accepted_once_across_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = parts(spark, path, [[("a", 100), ("b", 100)], [("a", 100), ("a", 101)]])
    events = stream(spark, path, schema).select(F.col("k").alias("job_id"), F.col("sec").alias("retry_count"), "ts")
    st.run_available(st.dedup_events_stream(events), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).select("job_id", "retry_count").collect()
    assert sorted(map(tuple, got)) == [("a", 100), ("a", 101), ("b", 100)]


def test_cancellations(spark, tmp_path):
    path = str(tmp_path / "in")
    values = ['{"job_id": "a", "action": "cancel"}', '{"job_id": "b", "status": "x"}', "broken"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    df.coalesce(1).write.parquet(path)
    cancels = st.cancellations(stream(spark, path, df.schema), "job_id string, action string")
    st.run_available(cancels, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert [r["job_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a"]


@pytest.mark.parametrize("files", [4, 12])
def test_results_do_not_depend_on_micro_batches(spark, tmp_path, rows, files):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    # Every file spans the whole time range, and none is in order.
    schema = parts(spark, path, [[(f"k{i % 4}", (i * 7919 + b * 31) % 90_000) for i in range(60)] for b in range(files)])
    counts = lambda df: st.windowed_counts(df, ["k"], "ts", "15 minutes")
    st.run_parts(stream(spark, path, schema), out, str(tmp_path / "ck"), counts)
    got = st.read_parts(spark, out)
    assert got.select("batch").distinct().count() == files
    merged = got.groupBy("window_start", "k").agg(F.sum("count").alias("count"))
    assert rows(merged) == rows(count_over_time(spark.read.parquet(path), ["k"], "ts"))
