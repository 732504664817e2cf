"""Random inputs against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from lakekit.operators import metrics as m
from lakekit.operators.ordered import Ordered
from lakekit.operators.paging import keyset
from lakekit.operators.transforms import bucketize
from lakekit.sources.scan import inventory

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
amounts = hs.floats(0, 300, allow_nan=False).map(lambda v: round(v, 2))
BOUNDS = [10, 25, 50, 100, 250]


def python_quantile(values, q):
    if not values:
        return None
    cumulative = [sum(v <= b for v in values) for b in BOUNDS] + [len(values)]
    rank = q * len(values)
    i = next(i for i, c in enumerate(cumulative) if c >= rank)
    if i == len(BOUNDS):
        return float(BOUNDS[-1])
    low, under = (BOUNDS[i - 1], cumulative[i - 1]) if i else (0, 0)
    return low + (BOUNDS[i] - low) * (rank - under) / (cumulative[i] - under)


@few
@given(hs.lists(hs.lists(amounts, min_size=1, max_size=20), min_size=1, max_size=8), hs.sampled_from([0.1, 0.5, 0.95, 1.0]))
def test_quantiles(spark, groups, q):
    data = [(f"g{i}", v) for i, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(data, "job string, v double").withColumn("ts", F.timestamp_seconds(F.lit(0)))
    got = m.hist_quantile(m.histogram(df, ["job"], "ts", "v", BOUNDS), q, ["job"]).collect()
    for r in got:
        want = python_quantile(groups[int(r["job"][1:])], q)
        assert abs(r["quantile"] - want) < 1e-9


@few
@given(hs.lists(hs.lists(hs.integers(0, 30), min_size=1, max_size=15), min_size=1, max_size=6), hs.sampled_from([3, 1000]))
def test_counter_growth(spark, series, run_rows):
    data = [(f"s{i}", t, v) for i, values in enumerate(series) for t, v in enumerate(values)]
    df = spark.createDataFrame(data, "job string, ts int, value int")
    got = m.deltas(df, ["job"], ["ts"], "value", run_rows=run_rows).groupBy("job").agg(F.sum("delta")).collect()
    for job, total in got:
        values = series[int(job[1:])]
        assert total == sum(b if b < a else b - a for a, b in zip(values, values[1:]))


@few
@given(hs.lists(hs.tuples(hs.sampled_from(["a", "b", None]), hs.integers(0, 5)), min_size=1, max_size=40), hs.integers(1, 9))
def test_numbering(spark, pairs, run_rows):
    data = [(k, t, i) for i, (k, t) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k string, t int, i int")
    got = Ordered(df, ["k"], ["t", "i"], run_rows).running(sums={"n": F.lit(1)}).result().collect()
    for key in {k for k, _ in pairs}:
        ranked = [r["i"] for r in sorted((r for r in got if r["k"] == key), key=lambda r: r["n"])]
        assert ranked == [i for k, t, i in sorted((d for d in data if d[0] == key), key=lambda d: d[1:])]


@few
@given(hs.lists(hs.one_of(hs.none(), amounts), min_size=1, max_size=30))
def test_buckets(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "amount double")
    for amount, bucket in bucketize(df, "amount").collect():
        want = "high" if amount is None or amount >= 200 else "low" if amount < 50 else "medium"
        assert bucket == want


def test_pages_over_an_inventory(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"f{i}").write_text("x")
    files = inventory(spark, str(tmp_path))
    first = keyset(files, "key", size=4).collect()
    rest = keyset(files, "key", first[-1]["next_token"], 4).collect()
    assert [r["key"] for r in first + rest] == [f"f{i}" for i in range(7)]
    assert first[0]["is_truncated"] and not rest[0]["is_truncated"]
