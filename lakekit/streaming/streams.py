"""Structured Streaming: sources, stateful operators and replay-safe sinks.

A run with `run_available` takes everything present in micro-batches of bounded size and stops;
the same frames can be started with any other trigger.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from lakekit.functions.logs import add_labels, parse_log
from lakekit.operators.metrics import width_seconds
from lakekit.operators.ordered import Ordered

# Bounds a micro-batch, and with it the rows that one key can bring to one task at a time.
MAX_BYTES_PER_TRIGGER = 64 << 30

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    max_bytes: int = MAX_BYTES_PER_TRIGGER,
) -> DataFrame:
    """New files under `path` as a stream, oldest first, in micro-batches of about `max_bytes`."""
    reader = spark.readStream.format(fmt).option("maxBytesPerTrigger", max_bytes)
    return (reader.schema(schema) if schema is not None else reader).load(path)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, on disk instead of in memory."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def run_available(sdf: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Append to a Parquet dataset until the input is used up."""
    writer = sdf.writeStream.format("parquet").outputMode(mode).option("path", path)
    _finish(sdf.sparkSession, writer, checkpoint)


def run_each(sdf: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Call `save` with every micro-batch and its number until the input is used up.

    The batch is kept while `save` runs, since a sort or a second pass would compute it again.
    """

    def kept(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            save(batch, batch_id)
        finally:
            batch.unpersist()

    _finish(sdf.sparkSession, sdf.writeStream.foreachBatch(kept).outputMode(mode), checkpoint)


def _finish(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> None:
    with rocksdb_state(spark):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_batches(
    sdf: DataFrame, path: str, checkpoint: str, order: list[str] | None = None, mode: str = "append"
) -> None:
    """Write every micro-batch, sorted by `order`, to a folder of its own until the input is used up.

    A batch that is run again after a failure replaces its folder, so no row is written twice.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.orderBy(*order) if order else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    run_each(sdf, save, checkpoint, mode)


def run_parts(sdf: DataFrame, path: str, checkpoint: str, part: Callable[[DataFrame], DataFrame]) -> None:
    """Write `part(micro-batch)` to `path/batch=N` until the input is used up.

    For results that must not depend on how the input falls into micro-batches: each is reduced to what can be merged
    (counts, first rows), without a watermark, and `read_parts` gives them all for merging.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        part(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    _finish(sdf.sparkSession, sdf.writeStream.foreachBatch(save), checkpoint)


def read_parts(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """What `run_parts` or `run_batches` wrote, with the number of the micro-batch as `batch`, whatever type the folders' names infer to."""
    rows = (spark.read.schema(schema) if schema is not None else spark.read).option("basePath", path).parquet(path)
    return rows.withColumn("batch", F.col("batch").cast("bigint"))


def windowed_counts(df: DataFrame, series: list[str], ts: str, width: str, step: str | None = None) -> DataFrame:
    """Rows for each series and window, of a batch or micro-batch; these add up over micro-batches."""
    window = F.window(ts, width, step) if step else F.window(ts, width)
    counts = df.groupBy(window.alias("_window"), *series).agg(F.count("*").alias("count"))
    return counts.select(F.col("_window.start").alias("window_start"), *series, "count")


def ingest_logs(
    spark: SparkSession,
    in_dir: str,
    out: str,
    checkpoint: str,
    labels: dict,
    glob: str = "*",
    max_bytes: int = MAX_BYTES_PER_TRIGGER,
) -> None:
    """Follow log files from their head: parse, label, append. Offsets are kept in `checkpoint`."""
    lines = (
        spark.readStream.format("text")
        .option("maxBytesPerTrigger", max_bytes)
        .option("pathGlobFilter", glob)
        .load(in_dir)
        .withColumnRenamed("value", "line")
    )
    run_available(add_labels(parse_log(lines), **labels), out, checkpoint)


def tail_stream(sdf: DataFrame, ts: str, key: str, delay: str = "10 minutes") -> DataFrame:
    """Each line once, identified by `key`; lines older than the watermark are not shown again."""
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def dedup_events_stream(
    sdf: DataFrame, keys: list[str] = ("job_id", "retry_count"), ts: str = "ts", delay: str = "10 minutes"
) -> DataFrame:
    """Accept each key once while its state is kept, which lasts `delay` of event time."""
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def count_over_time_stream(
    sdf: DataFrame, series: list[str], ts: str, width: str = "15 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Rows for each series and tumbling window. Rows are counted before the shuffle."""
    grouped = sdf.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("_window"), *series)
    return grouped.agg(F.count("*").alias("count")).select(
        F.col("_window.start").alias("window_start"), *series, "count"
    )


def sliding_rate(
    sdf: DataFrame,
    series: list[str],
    ts: str,
    width: str = "5 minutes",
    step: str = "1 minute",
    delay: str = "10 minutes",
) -> DataFrame:
    """Rows per second in a window that moves on by `step`; each row falls into width / step windows."""
    grouped = sdf.withWatermark(ts, delay).groupBy(F.window(ts, width, step).alias("_window"), *series)
    return grouped.agg((F.count("*") / F.lit(width_seconds(width))).alias("rate")).select(
        F.col("_window.start").alias("window_start"), *series, "rate"
    )


def pane_samples(batch: DataFrame, series: list[str], order: list[str], val: str, step: str = "1 minute") -> DataFrame:
    """The counter samples of a micro-batch, packed by series and pane of `step` length; the first `order` column is the time.

    Samples of a pane may be spread over micro-batches in any order, so the growth between them is only known after merging.
    """
    sample = F.struct(*order, F.col(val).alias("_value"))
    panes = batch.groupBy(F.window(order[0], step).alias("_window"), *series).agg(F.collect_list(sample).alias("samples"))
    return panes.select(F.col("_window.start").alias("pane"), *series, "samples")


def counter_rates(
    panes: DataFrame,
    series: list[str],
    by: list[str],
    width: str = "5 minutes",
    step: str = "1 minute",
    run_rows: int | None = None,
) -> DataFrame:
    """Growth per second of counters in windows of `width` that move on by `step`, summed over the series of each `by` group.

    `panes` is what `pane_samples` gave for all micro-batches. A lower value means that the counter restarted from zero; growth
    counts at its later sample, and the first sample of a series adds nothing. Each pane, not each sample, goes to its windows.
    """
    value = panes.schema["samples"].dataType.elementType["_value"].dataType
    whole = panes.groupBy("pane", *series).agg(F.sort_array(F.flatten(F.collect_list("samples"))).alias("_samples"))
    values = F.transform("_samples", lambda s: s["_value"])
    rest = F.size("_samples") - 1

    def growth(now: Column, before: Column) -> Column:
        return F.when(now < before, now).otherwise(now - before)

    steps = F.zip_with(F.slice(values, F.lit(2), rest), F.slice(values, F.lit(1), rest), growth)
    ends = whole.select(
        "pane",
        *series,
        F.get(values, F.lit(0)).alias("_first"),
        F.element_at(values, -1).alias("_last"),
        F.aggregate(steps, F.lit(0).cast(value), lambda total, x: (total + x).cast(value)).alias("_inside"),
    )
    carried = F.when(F.col("_before").isNull(), F.lit(0)).otherwise(growth(F.col("_first"), F.col("_before")))
    grown = (
        Ordered(ends, series, ["pane"], run_rows)
        .sliding(1, lambda rows, spec: rows.withColumn("_before", F.lag("_last").over(spec)))
        .map(lambda rows: rows.withColumn("_growth", F.col("_inside") + carried))
        .result()
    )
    back = F.expr(f"INTERVAL '{width_seconds(width) - width_seconds(step)}' SECOND")
    starts = F.sequence(F.col("pane") - back, F.col("pane"), F.expr(f"INTERVAL '{width_seconds(step)}' SECOND"))
    per_second = (F.sum("_growth") / F.lit(float(width_seconds(width)))).alias("rate")
    return grown.select(F.explode(starts).alias("window_start"), *by, "_growth").groupBy("window_start", *by).agg(per_second)


def cancellations(sdf: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """The cancel requests among JSON events."""
    event = F.from_json(F.col(value).cast("string"), schema)
    return sdf.select(event.alias("_event")).select("_event.*").filter(F.col("action") == "cancel")
