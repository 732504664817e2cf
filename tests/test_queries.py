"""Every registered query against its SQL on the smallest test data."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from lakekit.plans.registry import QUERIES
from lakekit.operators.transforms import stamp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def canonical(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(t[i]) for i in order) for t in tuples]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    got = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got.count() > 0
        return
    want = db.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got.columns, got.collect()) == canonical(want.columns, want.fetchall())


ORDERED = ["counter_rate", "moving_average", "schema_history", "snapshot_log", "job_lifecycle", "stream_job_lifecycle"]


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_every_key_cut(spark, db, name):
    spark.conf.set("spark.lakekit.runRows", "12")
    try:
        test_query(spark, db, name)
    finally:
        spark.conf.unset("spark.lakekit.runRows")


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_stamp_is_one_recent_value(spark):
    before = dt.datetime.now()
    times = stamp(spark.range(1000, numPartitions=8)).select("processed_at").distinct().collect()
    assert len(times) == 1 and before - dt.timedelta(seconds=1) <= times[0][0] <= dt.datetime.now()
