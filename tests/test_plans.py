"""Physical plans: pushdown, pruning, early cuts, no Python in batch queries."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lakekit.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
STREAMS = [n for n in QUERIES if n.startswith("stream_")]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def plan_of(spark, name):
    return plan(contract.queries()[name](spark, SF))


@pytest.mark.parametrize(
    "name,text",
    [
        ("filter_gt", "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]"),
        ("time_range", "GreaterThanOrEqual(ts,2024-01-14T12:00)"),
        ("scan_parquet", "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>"),
        ("row_count", "ReadSchema: struct<>"),
        ("agg_by_two_keys", "ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_linestatus:string>"),
        ("object_inventory", "ReadSchema: struct<>"),
        ("read_as_of", "PartitionFilters: [snapshot_id"),
        ("tail_n", "TakeOrderedAndProject"),
        ("log_query", "TakeOrderedAndProject"),
        ("log_query", "GreaterThanOrEqual(ts,2024-01-02T00:00)"),
        ("topk_groups", "TakeOrderedAndProject"),
        ("latest_per_key", "WindowGroupLimit"),
        ("dedup_by_key", "WindowGroupLimit"),
        ("idempotent_events", "WindowGroupLimit"),
        ("topk_per_window", "WindowGroupLimit"),
    ],
)
def test_plan_contains(spark, name, text):
    assert text in plan_of(spark, name)


def test_readers_prune_two_keys(spark):
    stored = contract.queries()["sink_multi_partitioned"](spark, SF)
    text = plan(stored.filter((F.col("o_orderstatus") == "F") & (F.col("year") == "1998")))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text and "(year#" in text.split("PartitionFilters")[1]
    assert stored.filter("o_orderstatus = 'F' AND year = '1998'").select(F.input_file_name()).distinct().count() == 1


@pytest.mark.parametrize("name", ["job_lifecycle", "moving_average", "schema_versioning", "latest_per_key", "dedup_report"])
def test_shuffles(spark, name):
    body = plan_of(spark, name).split("\n\n")[0]
    assert body.count("Exchange") == (2 if name == "dedup_report" else 1)


def test_join_summary_does_not_shuffle_the_fact_table(spark):
    body = plan_of(spark, "join_agg").split("\n\n")[0]
    # The groups alone: the dimension is broadcast.
    assert body.count("Exchange") - body.count("BroadcastExchange") == 1


def test_batch_queries_stay_in_the_jvm(spark):
    for name in QUERIES:
        if name not in [*STREAMS, "object_inventory"]:  # a listing
            text = plan_of(spark, name)
            assert "Python" not in text and "Pandas" not in text, name
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_no_unpartitioned_window_over_a_table(spark):
    for name in ("filtered_total", "offset_page", "tail_n", "newest_first"):
        assert "Window" not in plan_of(spark, name)
