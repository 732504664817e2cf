"""Counters, histograms and windows against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from lakekit.operators import metrics as m


def samples(spark, data):
    return spark.createDataFrame(data, "job string, sec long, value long").select(
        "job", F.timestamp_seconds(F.col("sec")).alias("ts"), "value"
    )


def test_reset_counts_new_value(spark):
    df = samples(spark, [("a", 0, 5), ("a", 15, 9), ("a", 30, 2), ("a", 45, 2), ("b", 0, 100)])
    got = {r["job"]: r["increase"] for r in m.increase(df, ["job"], ["ts"], "value").collect()}
    assert got == {"a": 6, "b": 0}


def test_rate_sums_series(spark):
    df = samples(spark, [("a", 0, 0), ("a", 30, 60), ("b", 0, 0), ("b", 30, 30)]).withColumn("all", F.lit("x"))
    got = m.rate(df, ["job"], ["all"], ["ts"], "value").collect()
    assert [r["rate"] for r in got] == [1.5]


def test_growth_belongs_to_later_window(spark):
    df = samples(spark, [("a", 50, 1), ("a", 70, 4)])
    got = m.increase(df, ["job"], ["ts"], "value", "1 minute").orderBy("window_start").collect()
    assert [r["increase"] for r in got] == [0, 3]


def test_latest(spark):
    df = samples(spark, [("a", 0, 5), ("a", 15, 1), ("b", 3, 7)])
    assert sorted(r["value"] for r in m.latest(df, ["job"], "ts").collect()) == [1, 7]


def quantile(spark, values, q, bounds=(10, 25, 50)):
    df = spark.createDataFrame([("a", float(v)) for v in values], "job string, v double")
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(0)))
    buckets = m.histogram(df, ["job"], "ts", "v", list(bounds))
    return m.hist_quantile(buckets, q, ["job"]).first()["quantile"]


def test_quantile_inside_a_bucket(spark):
    assert quantile(spark, [5, 5, 20, 20], 0.75) == pytest.approx(10 + 15 * 0.5)


def test_quantile_first_bucket_starts_at_zero(spark):
    assert quantile(spark, [9, 9], 0.5) == pytest.approx(5)


def test_quantile_past_last_bound(spark):
    assert quantile(spark, [5, 999], 0.99) == 50


def test_quantile_at_exact_boundary(spark):
    assert quantile(spark, [5, 30], 0.5) == pytest.approx(10)


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([("a", "10", 0), ("a", "+Inf", 0), ("b", "10", 4)], "job string, le string, cumulative long")
    assert [r["quantile"] for r in m.hist_quantile(empty, 0.9, ["job"]).collect()] == [None, None]


def test_quantile_for_each_window_from_counters(spark):
    # (le, second, value): the second window has grown by 0, 10, 10; the third follows a restart that bucket 25 does not show.
    values = [("10", 0, 4), ("25", 0, 4), ("+Inf", 0, 9), ("10", 100, 6), ("25", 100, 8), ("+Inf", 100, 13)]
    values += [("10", 400, 6), ("25", 400, 18), ("+Inf", 400, 23), ("10", 700, 5), ("25", 700, 19), ("+Inf", 700, 8)]
    df = spark.createDataFrame(values, "le string, sec long, value long").withColumn("ts", F.timestamp_seconds("sec"))
    df = df.withColumn("job", F.lit("a"))
    got = m.quantile_over_time(df, 0.5, ["job"], ["job"], ["ts"], "value").orderBy("window_start").collect()
    # Growth 2, 4, 4; then 0, 10, 10; then 5, 1 (raised to 5), 8.
    assert [r["quantile"] for r in got] == [pytest.approx(10), pytest.approx(17.5), pytest.approx(8)]


def test_bucket_bounds_are_inclusive(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 10.5), ("a", None)], "job string, v double")
    got = m.histogram(df.withColumn("ts", F.timestamp_seconds(F.lit(0))), ["job"], "ts", "v", [10, 25]).collect()
    assert {r["le"]: r["cumulative"] for r in got} == {"10": 1, "25": 2, "+Inf": 2}


def test_quantile_close_to_exact(spark):
    values = [i / 10 for i in range(1, 501)]
    assert abs(quantile(spark, values, 0.95) - 47.5) < 25
