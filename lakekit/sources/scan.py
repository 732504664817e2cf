"""Reading datasets."""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.operators.paging import top_rows


def scan(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """A Parquet dataset, reading only `cols`."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def read_merged(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A dataset whose files have older and newer schemas; missing columns read as null.

    With `schema` the file footers need not be merged, which matters for very many files.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first `n` rows by `order`."""
    return top_rows(df, order, n)


def inventory(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """All objects under `root` whose key starts with `prefix`: key, size, last_modified; empty and hidden ones too.

    The driver lists the first level alone; tasks list what lies below it. Arrow reaches the store by its URI; a path without a
    scheme is a local one.
    """
    system, base = _store(root)
    top = system.get_file_info(fs.FileSelector(base))
    folders = [(f.path,) for f in top if f.type == fs.FileType.Directory]
    here = [_entry(f, base) for f in top if f.type == fs.FileType.File]
    files = spark.createDataFrame(here, INVENTORY)
    if folders:
        below = spark.createDataFrame(folders, "folder string").repartition(min(len(folders), 10_000))
        files = files.unionByName(below.mapInArrow(_list(root), INVENTORY))
    return files.filter(F.col("key").startswith(prefix))


INVENTORY = "key string, size long, last_modified timestamp"


def _store(root: str) -> tuple[fs.FileSystem, str]:
    uri = root if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", root) else f"file://{os.path.abspath(root)}"
    system, base = fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", uri))
    return system, base.rstrip("/")


def _entry(info: fs.FileInfo, base: str) -> tuple:
    return info.path[len(base) :].lstrip("/"), info.size, info.mtime


def _list(root: str):
    def run(batches):
        system, base = _store(root)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                found = system.get_file_info(fs.FileSelector(folder, recursive=True))
                rows = list(zip(*[_entry(f, base) for f in found if f.type == fs.FileType.File]))
                kinds = (pa.string(), pa.int64(), pa.timestamp("us", "UTC"))
                columns = rows or [[], [], []]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "size", "last_modified"])

    return run
