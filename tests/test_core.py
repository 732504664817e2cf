"""Edge cases of projections, filters, joins, aggregates, pages and quality rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakekit.functions import logs as lg
from lakekit.functions import scalars as sc
from lakekit.operators import aggregates as a
from lakekit.operators import joins as j
from lakekit.operators import paging as p
from lakekit.operators import quality as q
from lakekit.operators import transforms as t
from lakekit.operators import windows as w
from lakekit.plans.order_flow import order_flow


def one(df):
    return [r[0] for r in df.collect()]


def test_bucket_bounds_and_null(spark):
    df = spark.createDataFrame([(0, 49.99), (1, 50.0), (2, 199.99), (3, 200.0), (4, None)], "i int, amount double")
    got = one(t.bucketize(df, "amount").orderBy("i").select("amount_bucket"))
    assert got == ["low", "medium", "medium", "high", "high"]


def test_tax_rounds_half_up(spark):
    df = spark.createDataFrame([(12.5,), (0.25,), (None,)], "amount double")
    assert one(t.with_tax(df, "amount").select("amount_tax")) == [14.75, 0.3, None]


def test_tax_keeps_more_than_two_digits_of_input(spark):
    df = spark.createDataFrame([(0.0045,)], "amount double")
    assert one(t.with_tax(df, "amount").select("amount_tax")) == [0.01]


def test_flag_uses_unrounded_product(spark):
    df = spark.createDataFrame([(1, 1000.001), (1, 1000.0)], "quantity int, unit_price double")
    assert one(t.with_flag(df, t.product("quantity", "unit_price") > 1000, "f").select("f")) == [True, False]


def test_filters_drop_nulls(spark):
    df = spark.createDataFrame([("a", 1), (None, None), ("b", 5)], "s string, v int")
    assert one(t.where_ne(df, "s", "a")) == ["b"]
    assert one(t.where_gt(df, "v", 1)) == ["b"]


def test_where_all_skips_missing(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1)], "s string, v int")
    assert t.where_all(df, s="a", v=None).count() == 2
    assert t.where_all(df, s="", v=0).count() == 1


def test_regex_is_anchored(spark):
    df = spark.createDataFrame([("a",), ("ab",), ("b",)], "s string")
    assert one(t.match_regex(df, "s", "a|b")) == ["a", "b"]


def test_source_all(spark):
    df = spark.createDataFrame([("1", "driver"), ("1", "stderr"), ("2", "driver")], "job_id string, source string")
    assert t.match_labels(df, job_id="1").count() == 2
    assert t.match_labels(df, source="driver", job_id="1").count() == 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_range_excludes_end(spark, kind):
    times = ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00"]
    df = spark.createDataFrame([(x,) for x in times], "s string").select(F.col("s").cast(kind).alias("ts"))
    end = datetime(2024, 1, 2)
    assert t.in_range(df, "ts", end=end).count() == 2
    assert t.in_range(df, "ts", datetime(2024, 1, 1, 1), end).count() == 1
    assert t.in_range(df, "ts").count() == 0


def test_name_rules(spark):
    names = ["ok_1", "1bad", "has space", "", None, "x" * 255, "x" * 256]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert one(t.check_pattern(df, "n").select("is_valid")) == [True, False, False, False, False, True, False]
    buckets = spark.createDataFrame([("ab",), ("my-bucket",), ("Upper",), ("-x-",)], "n string")
    rule = t.check_pattern(buckets, "n", t.BUCKET_NAME, *t.BUCKET_NAME_LENGTH)
    assert one(rule.select("is_valid")) == [False, True, False, False]


def test_join_column_order(spark):
    left = spark.createDataFrame([(1, "x")], "a int, k string")
    right = spark.createDataFrame([("x", 2)], "k string, b int")
    assert j.join_inner(left, right, "k").columns == ["k", "a", "b"]


def test_child_count_zero_and_null_key(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert dict(map(tuple, j.child_count(parent, child, "k").collect())) == {1: 2, 2: 0}


def test_dedup_counts_null_key_once(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    assert tuple(a.dedup_report(df, ["k"]).first()) == (4, 2, 2)
    assert sorted(r["v"] for r in p.dedup(df, ["k"], ["v"]).collect()) == [1, 3]


def test_summaries_of_empty_and_null(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "k string, v double")
    assert tuple(a.summarize(df, ["k"], "v").first()) == ("a", 2, None, None)
    assert tuple(a.dedup_report(df.filter("false"), ["k"]).first()) == (0, 0, 0)


def test_pivot_null_cell_and_found_values(spark):
    df = spark.createDataFrame([("n", "x", 1.005), ("s", "y", 2.0)], "r string, m string, v double")
    given = a.pivot_sum(df, "r", "m", "v", ["x", "y"]).orderBy("r").collect()
    assert [tuple(r) for r in given] == [("n", 1.01, None), ("s", None, 2.0)]
    assert a.pivot_sum(df, "r", "m", "v").orderBy("r").collect() == given


def test_sample_deviation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "k string, v double")
    got = {r["k"]: r["stddev"] for r in a.distribution(df, "k", "v").collect()}
    assert got == {"a": 0.71, "b": None}


def test_short_frames(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 5)], "k string, i int, v double")
    got = w.moving_avg(df, "k", ["i"], "v").orderBy("i").select("moving_avg")
    assert one(got) == [1.0, 1.5, 2.0, 3.0]


def test_next_version(spark):
    tables = spark.createDataFrame([("a",), ("b",)], "t string")
    history = spark.createDataFrame([("a", 1), ("a", 4)], "t string, version int")
    assert dict(map(tuple, w.next_version(history, tables, "t").collect())) == {"a": 5, "b": 1}


def test_page_limits(spark):
    df = spark.range(45).withColumnRenamed("id", "ts")
    assert one(p.page_of(df, ["ts"], 3)) == [4, 3, 2, 1, 0]
    assert one(p.page_of(df, ["ts"], 4)) == []
    for page, size in ((0, 20), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            p.page_of(df, ["ts"], page, size)
    with pytest.raises(ValueError):
        p.tail(df, "ts", 10_001)


def test_keyset_walk(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    after, seen = None, []
    while True:
        page = p.keyset(df, "k", after, 10).collect()
        seen += [r["k"] for r in page]
        after = page[-1]["next_token"]
        if not page[0]["is_truncated"]:
            break
    assert seen == list(range(25)) and after is None


def test_total_beside_page(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else "y") for i in range(50)], "ts int, s string")
    page = a.filtered_total(df, ["ts"], s="x", other=None).collect()
    assert len(page) == 20 and {r["total"] for r in page} == {25}


def test_topk_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "k string, v int")
    assert one(p.topk_groups(df, ["k"], F.sum("v"), 2)) == ["a", "b"]


def test_gate(spark, tmp_path):
    schema = "order_id long, item string, quantity int, unit_price double, status string"
    good = spark.createDataFrame([(1, "i", 2, 600.0, "shipped"), (2, None, 1, 1.0, "pending")], schema)
    out = order_flow(good, str(tmp_path / "out")).collect()
    assert [(r["total_price"], r["is_high_value"]) for r in out] == [(1200.0, True)]
    for bad in ((3, None, 1, 1.0, "shipped"), (4, "i", 1, -1.0, "shipped")):
        with pytest.raises(q.QualityError):
            order_flow(spark.createDataFrame([bad], schema), str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()


def test_log_lines(spark):
    lines = ["[2024-01-01T00:00:07Z] [WARN] a [b] c", "no prefix", "[when] [INFO] x", ""]
    got = lg.parse_log(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert [(r["level"], r["message"]) for r in got] == [
        ("WARN", "a [b] c"), (None, "no prefix"), ("INFO", "x"), (None, ""),
    ]
    assert [r["ts"] is None for r in got] == [False, True, True, True]


def test_nanoseconds(spark):
    df = spark.createDataFrame([(1_700_000_000_123_456_789,), (-1_000,), (None,)], "ns long")
    back = df.select(lg.ts_to_ns(lg.ns_to_ts("ns")))
    assert one(back) == [1_700_000_000_123_456_000, -1_000, None]


def test_format_log(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07' ts UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:07.5'")
    got = sorted(one(df.select(lg.format_log("ts", F.lit("driver"), F.lit("m")))))
    assert got == ["[2024-01-01T00:00:07.500000] [driver] m", "[2024-01-01T00:00:07] [driver] m"]


def test_names_and_paths(spark):
    df = spark.createDataFrame([("abcd1234-5678", 2)], "id string, r int")
    assert one(df.select(sc.attempt_name("id", "r"))) == ["spark-job-abcd1234-r2"]
    place = sc.table_location("s3://w/", F.lit("db"), F.lit("t"))
    assert one(df.select(sc.to_s3a(place))) == ["s3a://w/db/t/"]


def test_map_merge(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) l, map('b', 3, 'c', 4) r")
    assert one(df.select(sc.map_merge("l", "r"))) == [{"a": 1, "b": 3, "c": 4}]


def test_json_field(spark):
    df = spark.createDataFrame([('{"a": {"b": 7}}',), ("broken",), ('{"a": {"b": "x"}}',)], "j string")
    assert one(df.select(sc.json_field("j", "$.a.b", "int"))) == [7, None, None]


def test_many_first_rows(spark):
    df = spark.range(5000).select("id", (F.col("id") % 2).alias("k"))
    got = p.topk_per(df, ["k"], "id", 1500).agg(F.min("id"), F.count("*")).first()
    assert tuple(got) == (2000, 3000)


def test_keyset_walk_over_repeated_keys(spark):
    df = spark.createDataFrame([(i // 7, i) for i in range(20)], "k int, id int")
    seen, after = [], None
    while True:
        page = p.keyset(df, "k", after, 3, tie="id").collect()
        seen += [r["id"] for r in page]
        if not page[0]["is_truncated"]:
            break
        after = page[0]["next_token"]
    assert seen == list(range(20))
