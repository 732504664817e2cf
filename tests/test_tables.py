"""Generators, sinks, schema changes, layouts and snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakekit.operators import layout as lo
from lakekit.operators import schema as sch
from lakekit.plans import jobs
from lakekit.sources import synth as s
from lakekit.sources.json_events import decode_events, encode_events
from lakekit.sources.scan import inventory, read_merged
from lakekit.sources.sinks import sql_table, write

SPEC = {
    "id": s.sequence(1),
    "n": s.uniform_int(1, 100),
    "x": s.uniform(5, 500),
    "c": s.choice(["a", "b", "c"]),
    "g": s.gauss(100, 25),
    "u": s.prefixed_int("user_", 1, 9),
    "p": s.padded("txn_"),
    "m": s.modular("e_", 300),
    "k": s.constant("x"),
}


def test_synth_domains(spark):
    df = s.synth(spark, 3000, SPEC)
    got = df.agg(
        F.min("id"), F.max("id"), F.min("n"), F.max("n"), F.min("x") >= 5, F.max("x") <= 500,
        F.count_distinct("c"), F.count_distinct("u"), F.count_distinct("m"), F.count_distinct("k"),
        F.abs(F.mean("g") - 100) < 3, F.abs(F.stddev("g") - 25) < 2, F.max(F.abs(F.round("x", 2) - F.col("x"))),
    ).first()
    assert tuple(got) == (1, 3000, 1, 100, True, True, 3, 9, 300, 1, True, True, 0.0)
    assert df.filter("id = 43").first()["p"] == "txn_000042"


def test_synth_ignores_partitioning(spark, rows):
    ids = spark.range(200)
    spread = s.synth_columns(ids.repartition(7), "id", SPEC, 5)
    assert rows(spread) == rows(s.synth_columns(ids.coalesce(1), "id", SPEC, 5))
    assert rows(spread) != rows(s.synth_columns(ids, "id", SPEC, 6))


def test_append_overwrite_and_prune(spark, tmp_path):
    df = spark.createDataFrame([(1, "US", "2024"), (2, "DE", "2025"), (3, "US", "2025")], "id int, country string, year string")
    path = str(tmp_path / "t")
    write(df, path, "append", ["country", "year"])
    write(df, path, "append", ["country", "year"])
    back = spark.read.schema(df.schema).parquet(path)
    assert back.count() == 6 and back.schema["year"].dataType.simpleString() == "string"
    write(df, path, "overwrite", ["country", "year"])
    assert back.sparkSession.read.parquet(path).count() == 3
    assert sorted(f.name for f in (tmp_path / "t").glob("country=*")) == ["country=DE", "country=US"]


def test_one_file_for_a_small_partition(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 3).cast("string").alias("k"))
    write(df, str(tmp_path / "t"), partition_by=["k"])
    assert len(list((tmp_path / "t").glob("k=*/*.parquet"))) == 3


def test_large_partition_is_split(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        df = spark.range(0, 200_000, 1, 8).select(F.xxhash64("id").alias("v"), F.lit("hot").alias("k"))
        write(df, str(tmp_path / "t"), partition_by=["k"])
    finally:
        spark.conf.unset(key)
    assert len(list((tmp_path / "t").glob("k=hot/*.parquet"))) > 1


def test_sql_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "hello")], "id bigint, name string")
    assert sql_table(spark, "greetings", df, str(tmp_path / "g")).collect() == df.collect()
    spark.sql("DROP TABLE greetings")


def test_json_round_trip(spark, rows):
    df = spark.createDataFrame([("j1", 2, ["a"], {"k": "v"})], "job_id string, retry int, args array<string>, conf map<string,string>")
    sent = encode_events(df, "job_id")
    assert sent.columns == ["key", "value"] and sent.first()["key"] == "j1"
    assert rows(decode_events(sent, df.schema).drop("key")) == rows(df)
    assert decode_events(sent.withColumn("value", F.lit("{broken")), df.schema).first()["job_id"] is None


def test_inventory(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"12345")
    (tmp_path / "b.bin").write_bytes(b"1")
    (tmp_path / "a" / "_SUCCESS").write_bytes(b"")
    (tmp_path / ".hidden").write_bytes(b"12")
    got = inventory(spark, str(tmp_path)).collect()
    assert {(r["key"], r["size"]) for r in got} == {("a/x.bin", 5), ("b.bin", 1), ("a/_SUCCESS", 0), (".hidden", 2)}
    for root in (str(tmp_path), f"file://{tmp_path}"):
        assert [r["key"] for r in inventory(spark, root, "a/x").collect()] == ["a/x.bin"]


def test_declared_types(spark):
    assert sch.spark_type("decimal(10, 4)").simpleString() == "decimal(10,4)"
    for bad in ("varchar", "decimal(x)"):
        with pytest.raises(ValueError):
            sch.spark_type(bad)
    df = spark.createDataFrame([("1", "2.345")], "id string, amount string")
    typed = sch.apply_schema(df, [sch.Field("id", "long", False, "Transaction ID"), sch.Field("amount", "decimal")])
    assert str(typed.first()["amount"]) in ("2.35", "2.34")
    assert typed.schema["id"].metadata == {"comment": "Transaction ID"}
    with pytest.raises(ValueError):
        sch.apply_schema(df, [])


def test_required_null_fails(spark):
    df = spark.createDataFrame([("1",), (None,)], "id string")
    with pytest.raises(Exception, match="null in required column id"):
        sch.apply_schema(df, [sch.Field("id", "long", nullable=False)]).collect()


def test_evolve_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, old_column int, old_name int")
    out = sch.evolve(
        df,
        add=[sch.Field("region", "string"), sch.Field("brief", "int")],
        drop=["old_column", "brief", "missing"],
        rename={"old_name": "new_name", "missing": "x", "new_name": "newer"},
    )
    assert out.columns == ["a", "newer", "region"] and tuple(out.first()) == (1, 3, None)
    with pytest.raises(ValueError):
        sch.evolve(df, add=[sch.Field("a", "int")])


def test_history(spark):
    field = "struct<name:string,type:string,nullable:boolean,description:string>"
    schema = f"t string, ts int, fields array<{field}>, add array<{field}>, drop array<string>, rename array<struct<old:string,new:string>>, changed_by string"
    base = [("id", "long", True, None), ("old_name", "string", True, None)]
    data = [
        ("a", 1, base, [("region", "string", True, None)], ["gone"], [("old_name", "new_name")], "u1"),
        ("a", 2, base, [], [], [], "u2"),
        ("a", 3, base, [], [], [("ghost", "x")], "u3"),
        ("a", 4, base, [("tmp", "int", True, None)], ["tmp"], [("old_name", "mid"), ("mid", "end")], "u4"),
        ("a", 5, base, [], ["old_name"], [("old_name", "x")], "u5"),
    ]
    got = sch.history(spark.createDataFrame(data, schema), "t", ["ts"]).orderBy("ts").collect()
    assert [(r["ts"], r["version"], r["changed_by"]) for r in got] == [(1, 2, "u1"), (4, 3, "u4"), (5, 4, "u5")]
    assert [[f["name"] for f in r["fields"]] for r in got] == [["id", "new_name", "region"], ["id", "end"], ["id"]]
    assert [r["change_summary"] for r in got] == [
        "Added column: region (string); Dropped column: gone; Renamed column: old_name -> new_name",
        "Added column: tmp (int); Dropped column: tmp; Renamed column: old_name -> mid; Renamed column: mid -> end",
        "Dropped column: old_name",
    ]


@pytest.mark.parametrize("run_rows", [None, 3])
def test_changes_build_on_each_other(spark, run_rows):
    """Add, rename, rename, drop, add again; in one task, or run after run."""
    field = lambda n, t="string": (n, t, True, None)
    steps = [
        ([field("x")], [], []),
        ([], [], [("x", "y")]),
        (None, None, [("x", "lost")]),  # x is gone: nothing to log
        ([], [], [("y", "z"), ("amount", "total")]),
        ([], ["z", "none"], []),
        ([], [], [("z", "lost")]),
        ([field("x", "int"), field("x")], [], [("x", "first")]),
        ([], ["id"], []),
        ([], [], []),
    ]
    kind = f"t string, ts int, add array<{sch.FIELD}>, drop array<string>, rename array<struct<old:string,new:string>>, changed_by string"
    data = [("a", i, *s, f"u{i}") for i, s in enumerate(steps)] + [("b", 0, [field("k")], [], [], "u"), (None, None, [], ["id"], [], None)]
    start = [sch.Field("id", "long", False), sch.Field("amount", "decimal")]
    changes = spark.createDataFrame(data[::-1], kind).repartition(3)
    got = sch.accumulate(changes, "t", ["ts"], start, run_rows).collect()
    a = sorted((r for r in got if r["t"] == "a"), key=lambda r: r["version"])
    assert [(r["ts"], r["version"], ",".join(f["name"] for f in r["fields"]), r["change_summary"], r["changed_by"]) for r in a] == [
        (0, 2, "id,amount,x", "Added column: x (string)", "u0"),
        (1, 3, "id,amount,y", "Renamed column: x -> y", "u1"),
        (3, 4, "id,total,z", "Renamed column: y -> z; Renamed column: amount -> total", "u3"),
        (4, 5, "id,total", "Dropped column: z; Dropped column: none", "u4"),
        (6, 6, "id,total,first,x", "Added column: x (int); Added column: x (string); Renamed column: x -> first", "u6"),
        (7, 7, "total,first,x", "Dropped column: id", "u7"),
    ]
    assert [f["type"] for f in a[4]["fields"]] == ["long", "decimal", "int", "string"]
    assert sorted((r["t"] or "", r["version"], len(r["fields"])) for r in got if r["t"] != "a") == [("", 2, 1), ("b", 2, 3)]
    assert sch.accumulate(changes.where("false"), "t", ["ts"], start, run_rows).count() == 0


def test_mixed_schema(spark, tmp_path):
    path = str(tmp_path / "m")
    write(spark.createDataFrame([(1,)], "a int"), path, "append")
    write(spark.createDataFrame([(2, "x")], "a int, b string"), path, "append")
    want = [(1, None), (2, "x")]
    assert sorted(map(tuple, read_merged(spark, path).collect())) == want
    schema = spark.createDataFrame([], "a int, b string").schema
    assert sorted(map(tuple, read_merged(spark, path, schema).collect())) == want


def test_day_partitions(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 23:59:59' ts UNION ALL SELECT timestamp_ntz'2024-01-02 00:00:00'")
    assert lo.write_partitioned(df, str(tmp_path / "d"), [{"field": "ts", "transform": "day"}]) == ["ts_day"]
    assert sorted(f.name for f in (tmp_path / "d").glob("ts_day=*")) == ["ts_day=2024-01-01", "ts_day=2024-01-02"]
    with pytest.raises(ValueError):
        lo.write_partitioned(df, str(tmp_path / "e"), [{"field": "ts", "transform": "bucket"}])


def test_sorted_files(spark, tmp_path):
    df = spark.range(0, 5000, 1, 8).select((F.col("id") % 50).alias("v"))
    lo.write_sorted(df, str(tmp_path / "s"), [{"field": "v", "direction": "desc"}])
    ends = []
    for f in sorted((tmp_path / "s").glob("*.parquet")):
        values = [r["v"] for r in spark.read.parquet(str(f)).collect()]
        assert values == sorted(values, reverse=True)
        ends.append((values[-1], values[0]))
    assert all(a[0] >= b[1] for a, b in zip(ends, ends[1:]))


@pytest.fixture
def snapshot_table(spark, tmp_path):
    ops = ["append", "append", "overwrite", "append", "delete", "append"]
    times = [dt.datetime(2024, 1, 1, i) for i in range(6)]
    ids = [50, 10, 40, 20, 60, 30]
    log = spark.createDataFrame(list(zip(ids, ops, times)), "snapshot_id long, operation string, created_at timestamp")
    data = spark.createDataFrame([(i, i * 10) for i in ids], "snapshot_id long, v long")
    path = str(tmp_path / "t")
    write(data, path, partition_by=["snapshot_id"])
    return path, data.schema, log


@pytest.mark.parametrize("at,want", [(50, [50]), (10, [10, 50]), (40, [40]), (20, [20, 40]), (60, [20, 40]), (30, [20, 30, 40])])
def test_read_as_of(spark, snapshot_table, at, want):
    path, schema, log = snapshot_table
    got = lo.read_as_of(spark, path, schema, log, at)
    assert sorted(r["snapshot_id"] for r in got.collect()) == want


def test_unknown_snapshot(spark, snapshot_table):
    path, schema, log = snapshot_table
    with pytest.raises(ValueError):
        lo.read_as_of(spark, path, schema, log, 99)


def test_snapshot_log(spark, snapshot_table):
    log = snapshot_table[2].withColumn("table_id", F.lit("t"))
    got = lo.snapshots(log, "table_id", ["created_at"]).collect()
    assert [(r["snapshot_id"], r["parent_id"]) for r in got] == [
        (30, 60), (60, 20), (20, 40), (40, 10), (10, 50), (50, None),
    ]
    with pytest.raises(Exception, match="unknown operation"):
        lo.snapshots(log.withColumn("operation", F.lit("merge")), "table_id", ["created_at"]).collect()


@pytest.mark.parametrize("name", list(jobs.JOBS))
def test_job_runs(spark, tmp_path, name):
    shown = jobs.run_job(spark, name, str(tmp_path), 600)
    assert shown.count() > 0
    if name != "demo":
        assert spark.read.parquet(str(tmp_path / name)).count() > 0


def test_load_sales_appends(spark, tmp_path):
    for _ in range(2):
        summary = jobs.run_job(spark, "load_sales", str(tmp_path), 100)
    assert summary.agg(F.sum("count")).first()[0] == 100
    assert spark.read.parquet(str(tmp_path / "load_sales")).count() == 200
    jobs.run_job(spark, "load_sales", str(tmp_path), 100, mode="overwrite")
    assert spark.read.parquet(str(tmp_path / "load_sales")).count() == 100
