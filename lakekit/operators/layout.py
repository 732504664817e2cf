"""File layouts and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.operators.ordered import Ordered
from lakekit.sources.sinks import write

# What a snapshot may do.
OPERATIONS = ["append", "overwrite", "delete", "replace"]
RESETTING = ["overwrite", "replace"]

_TRANSFORMS = {
    "identity": lambda c: c,
    "day": lambda c: F.to_date(c),
}


def write_partitioned(df: DataFrame, path: str, spec: list[dict], mode: str = "overwrite") -> list[str]:
    """Write partitioned by `[{field, transform}]`; returns the partition columns added or used."""
    names = []
    for part in spec:
        transform = part.get("transform", "identity")
        if transform not in _TRANSFORMS:
            raise ValueError(f"unknown transform: {transform}")
        name = part["field"] if transform == "identity" else f"{part['field']}_{transform}"
        df = df.withColumn(name, _TRANSFORMS[transform](F.col(part["field"])))
        names.append(name)
    write(df, path, mode, names)
    return names


def write_sorted(df: DataFrame, path: str, order: list[dict], mode: str = "overwrite") -> None:
    """Write files in `[{field, direction}]` order: ranges of it across files, sorted inside each."""
    columns = [F.desc(o["field"]) if o.get("direction", "asc") == "desc" else F.asc(o["field"]) for o in order]
    # The row number lets equal values span several files.
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*columns, "_tie")
    ranged.sortWithinPartitions(*columns).drop("_tie").write.mode(mode).parquet(path)


def snapshots(
    df: DataFrame, table: str, order: list[str], snapshot: str = "snapshot_id", run_rows: int | None = None
) -> DataFrame:
    """The snapshot log with each snapshot's parent, newest first."""
    bad = F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce("operation", F.lit("null"))))
    checked = df.withColumn(
        "operation", F.when(F.col("operation").isin(OPERATIONS), F.col("operation")).otherwise(bad.cast("string"))
    )

    def add(rows: DataFrame, spec) -> DataFrame:
        return rows.withColumn("parent_id", F.lag(snapshot).over(spec))

    chained = Ordered(checked, [table], order, run_rows).sliding(1, add).result()
    return chained.orderBy(table, *[F.desc(c) for c in order])


def read_as_of(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    log: DataFrame,
    snapshot_id: int,
) -> DataFrame:
    """Rows visible at a snapshot: from the last overwrite or replace before it, up to it.

    Data lies in one folder for each `snapshot_id`, and only the visible folders are read. The log
    has one row for each commit; the driver lists one folder for each of them anyway.
    """
    commits = log.orderBy("created_at", "snapshot_id").select("snapshot_id", "operation").collect()
    ids = [c["snapshot_id"] for c in commits]
    if snapshot_id not in ids:
        raise ValueError(f"unknown snapshot: {snapshot_id}")
    until = commits[: ids.index(snapshot_id) + 1]
    resets = [i for i, c in enumerate(until) if c["operation"] in RESETTING]
    since = until[resets[-1] :] if resets else until
    visible = [c["snapshot_id"] for c in since if c["operation"] != "delete"]
    return spark.read.schema(schema).parquet(path).filter(F.col("snapshot_id").isin(visible))
