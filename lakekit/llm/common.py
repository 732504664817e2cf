"""Vectorised words, hashes and spans over Arrow text columns, and scratch tables, for the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakekit.session import scratch_path

CHUNK_BYTES = 4 << 20  # text that one numpy pass takes at a time; a longer document is a chunk of its own

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_S32, _S29, _S31 = np.uint64(32), np.uint64(29), np.uint64(31)

_BYTES = np.arange(256)
#: Words between ASCII white space, and words of ASCII letters, digits and all other code points.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
ALNUM = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

#: The same words for Spark's and DuckDB's regular expressions.
NOT_SPACE_RE = r"[^\x20\x09-\x0D]+"


@dataclass
class Words:
    """The words of a run of documents: `data[start:end]` each, `doc` counts documents from 0; `first` has n + 1 word offsets."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a text column; null counts as empty."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), at


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about `limit` bytes of text, with their bytes and offsets from 0."""
    data, at = text_buffers(batch.column(text))
    row, n = 0, batch.num_rows
    while row < n:
        end = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield batch.slice(row, end - row), data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def find_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Maximal runs of `word_bytes` inside each document."""
    size = len(data)
    padded = np.zeros(size + 8, np.uint8)
    padded[:size] = LOWER[data] if lower else data
    inside = np.zeros(size + 1, bool)
    inside[:size] = word_bytes[data]
    head = np.zeros(size + 1, bool)
    head[offsets] = True
    start = np.flatnonzero(inside[:size] & (head[:size] | ~np.concatenate([[False], inside[: max(size - 1, 0)]])[:size]))
    end = np.flatnonzero(inside[:size] & (head[1:] | ~inside[1:])) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(padded, start, end, doc, first, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _S32)
    h *= _MIX2
    h ^= h >> _S29
    h *= _MIX
    h ^= h >> _S32
    return h


def hash_words(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes at a time."""
    eight = np.ndarray((len(w.data) - 7,), np.dtype("<u8"), w.data, 0, (1,))
    length = w.end - w.start
    h = length.astype(np.uint64) * _MIX
    live, at = slice(None), w.start
    left = length
    while len(at):
        v = eight[at]
        short = left < 8
        if short.any():
            v = np.where(short, v & ((np.uint64(1) << (np.minimum(left, 7).astype(np.uint64) * np.uint64(8))) - np.uint64(1)), v)
        h[live] = mix(h[live] ^ v)
        more = np.flatnonzero(left > 8)
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def roll(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k hashes; the result has len(h) - k + 1 entries (none if that is negative)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out *= _MIX
        out += h[j : j + n]
        out ^= out >> _S31
    return mix(out)


def inside_one(w: Words, k: int) -> np.ndarray:
    """Word positions at which k words of one document begin."""
    n = len(w.doc) - k + 1
    return np.flatnonzero(w.doc[:n] == w.doc[k - 1 :]) if n > 0 else np.zeros(0, np.int64)


def cover(starts: np.ndarray, length, n: int) -> np.ndarray:
    """Which of n positions lie in [start, start + length) for any start."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:n]) > 0


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one after another."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - before, lengths)


def list_array(values: np.ndarray, lengths: np.ndarray, kind=None) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


scratch: list[str] = []  # folders written by this process, oldest first


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` once to shared storage and read it back: fixed rows, and no lineage beyond this point."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    scratch.append(path)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, label: str) -> str:
    path = scratch_path(spark, label)
    scratch.append(path)
    return path


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete scratch folders (all of them by default); call it once the results that read them are stored."""
    paths = scratch if paths is None else paths
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name := paths.pop())
        path.getFileSystem(conf).delete(path, True)
        if name in scratch:
            scratch.remove(name)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that `df` does not have, compared without case as Spark does."""
    have = {c.lower() for c in df.columns}
    return [n if n.lower() not in have else f"{n}_{uuid.uuid4().hex[:8]}" for n in names]


def tasks_for(spark: SparkSession, at_least: int = 1) -> int:
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hex_of(column) -> Column:
    return F.lower(F.hex(column))


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str, label: str) -> DataFrame:
    """Stored `rows` with `name`, their place from 0 within `group` (nulls first), stored in that order.

    One range shuffle and small counts by range, so no group is ever in one task, however large. Rows equal in `order` have any order
    among themselves. The window is over the ranges of one group, at most as many as the shuffle has partitions.
    """
    keys = [*group, *order]
    sorted_rows = (
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_row")
        .sortWithinPartitions(*keys, "_row")
        .select(*rows.columns, F.spark_partition_id().alias("_part"), F.expr("monotonically_increasing_id() & 8589934591L").alias("_seq"))
    )
    placed = materialize(sorted_rows, label)
    parts = placed.select(*[F.col(c).alias(f"_in_{c}") for c in group], F.col("_part").alias("_of"), "_seq")
    own = [f"_in_{c}" for c in group]
    parts = parts.groupBy(*own, "_of").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*(own or [F.lit(0)])).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_seq")
    same = F.col("_part") == F.col("_of")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_in_{c}"))
    return placed.join(parts, same).select(*rows.columns, (F.col("_seq") + F.col("_start")).alias(name))
