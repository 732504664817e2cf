"""Keys cut into runs give the same rows as plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakekit.operators.metrics import deltas
from lakekit.operators.ordered import Ordered
from lakekit.operators.paging import page_of
from lakekit.operators.windows import moving_avg, number_versions


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of the rows, one null key, and small keys; null values in places."""
    rng = random.Random(3)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{rng.randint(0, 40)}")
        value = None if rng.random() < 0.2 else float(rng.randint(0, 50))
        data.append((key, rng.randint(0, 500), i, value))
    return spark.createDataFrame(data, "key string, ts int, id int, value double").repartition(5)


@pytest.mark.parametrize("run_rows", [7, 60])
@pytest.mark.parametrize("before", [1, 2, 12])
def test_sliding(skewed, rows, run_rows, before):
    def add(df, w):
        return df.withColumns({"total": F.sum("value").over(w.rowsBetween(-before, 0)), "old": F.lag("value", before).over(w)})

    cut = Ordered(skewed, ["key"], ["ts", "id"], run_rows)
    assert cut.hot is not None
    want = add(skewed, Window.partitionBy("key").orderBy("ts", "id"))
    assert rows(cut.sliding(before, add).result(), *want.columns) == rows(want)


@pytest.mark.parametrize("run_rows", [7, 60])
def test_running(skewed, rows, run_rows):
    w = Window.partitionBy("key").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"n": F.sum(F.lit(1)).over(w), "seen": F.last("value", ignorenulls=True).over(w)})
    cut = Ordered(skewed, ["key"], ["ts", "id"], run_rows).running({"n": F.lit(1)}, {"seen": F.col("value")})
    assert rows(cut.result(), *want.columns) == rows(want)


def test_steps_chain(skewed, rows):
    def steps(run_rows):
        return (
            Ordered(skewed, ["key"], ["ts", "id"], run_rows)
            .running({"n": F.lit(1)})
            .sliding(1, lambda df, w: df.withColumn("previous", F.lag("n").over(w)))
            .map(lambda df: df.withColumn("step", F.col("n") - F.col("previous")))
            .running(lasts={"last_step": F.col("step")})
            .result()
        )

    assert rows(steps(9)) == rows(steps(10**6))


def test_whole_table_as_one_key(skewed, rows):
    numbered = Ordered(skewed, [], ["ts", "id"], 50).running({"n": F.lit(1)}).result()
    got = [r["id"] for r in numbered.orderBy("n").collect()]
    assert got == [r["id"] for r in skewed.orderBy("ts", "id").collect()]
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 901))


def test_copies_of_one_row(spark):
    copies = spark.range(300).select(F.lit("a").alias("key"), F.lit(1).alias("ts"))
    numbered = number_versions(copies, ["key"], ["ts"], run_rows=20)
    assert sorted(r["version"] for r in numbered.collect()) == list(range(1, 301))


def test_no_hot_key_keeps_one_shuffle(skewed):
    assert Ordered(skewed, ["key"], ["ts", "id"], 1000).hot is None


def test_moving_avg_and_deltas_on_runs(skewed, rows):
    filled = skewed.na.fill(1.0, ["value"])
    for op in (
        lambda n: moving_avg(filled, "key", ["ts", "id"], "value", 4, run_rows=n),
        lambda n: deltas(filled, ["key"], ["ts", "id"], "value", run_rows=n),
    ):
        assert rows(op(11)) == rows(op(10**6))


def test_empty(spark):
    empty = spark.createDataFrame([], "key string, ts int, value double")
    assert moving_avg(empty, "key", ["ts"], "value").count() == 0


@pytest.mark.parametrize("page", [1, 3, 9, 10])
def test_deep_page(skewed, page):
    got = [r["id"] for r in page_of(skewed, ["ts", "id"], page, 97).collect()]
    newest = sorted(((r["ts"], r["id"]) for r in skewed.collect()), reverse=True)
    assert got == [i for _, i in newest[(page - 1) * 97 : page * 97]]


@pytest.mark.parametrize("run_rows", [7, 11])
def test_ties_keep_their_order_on_both_paths(spark, rows, run_rows):
    rng = random.Random(run_rows)
    data = [("hot" if rng.random() < 0.7 else f"k{i % 5}", rng.randrange(6), float(i)) for i in range(300)]
    df = spark.createDataFrame(data, "key string, ts int, value double").coalesce(1)
    for op in (
        lambda n: moving_avg(df, "key", ["ts"], "value", 4, run_rows=n),
        lambda n: deltas(df, ["key"], ["ts"], "value", run_rows=n),
        lambda n: Ordered(df, ["key"], ["ts"], n).running({"s": F.col("value")}, {"l": F.col("value")}).result(),
    ):
        assert rows(op(run_rows)) == rows(op(10**6))
