"""Sharding by extendible hashing: a directory over hash prefixes, where only oversized buckets split; built-in expressions only.

Bytes are summed by a prefix somewhat longer than the expected depth, and from there for all shorter prefixes in one grouped sum. A
shard is a shortest prefix that fits the limit. Buckets too large at that depth go on with more bits in a further round, which
reads their rows alone. Rows move once at most, narrow, to meet their entry of the directory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import fresh, materialize

BITS = 60  # of each of the two hashes: by id, then by row, for rows that share an id


def hash_bits(value: Column) -> Column:
    """60 bits of an MD5 digest; null counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _cut(value: str, right: int) -> Column:
    return F.shiftright(value, right)


def directory(rows: DataFrame, used: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Of `rows(_base, _hash, bytes)`: (_base, _leaf, shard, shard_bytes, shard_docs) for what fits, (_base, _leaf) for the rest.

    `_base` is the bit string that its bucket has used up; `used` bits of this hash are in it, `depth` more are looked at.
    """
    leaves = rows.groupBy("_base", "_leaf").agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
    leaves = materialize(leaves, "leaves")
    steps = leaves.select("*", F.explode(F.sequence(F.lit(0 if not used else 1), F.lit(depth))).alias("d"))
    steps = steps.withColumn("p", F.expr(f"shiftright(_leaf, {depth} - d)"))
    nodes = steps.groupBy("_base", "d", "p").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
    fits = nodes.where(f"shard_bytes <= {limit} OR shard_docs = 1")
    first = (
        steps.select("_base", "_leaf", "d", "p")
        .join(fits, ["_base", "d", "p"])
        .groupBy("_base", "_leaf")
        .agg(F.min_by(F.struct("d", "p", "shard_bytes", "shard_docs"), "d").alias("at"))
    )
    name = F.concat("_base", F.when(F.col("at.d") > 0, F.expr("right(concat(repeat('0', 60), bin(at.p)), at.d)")).otherwise(""))
    found = first.select("_base", "_leaf", name.alias("shard"), "at.shard_bytes", "at.shard_docs")
    return found, leaves.join(first, ["_base", "_leaf"], "left_anti").select("_base", "_leaf")


def assign_shards(
    docs: DataFrame, doc_id: str = "doc_id", size: Column | str = "n_bytes", limit_bytes: int = 64 << 20, round_bits: int = 6
) -> DataFrame:
    """Each row of `docs` with n_bytes, shard (hash prefix as a bit string, empty while one shard holds all), shard_bytes and shard_docs.

    `size` gives a document's bytes, for instance octet_length of its text; null counts as 0. Shards hold at most `limit_bytes`,
    except that a single longer document is a shard of its own. A null doc_id hashes as the empty text. Rows that repeat an id share its hash; where they alone exceed the limit, 60
    further bits from a row number spread them. Extra columns pass through; the new names get a suffix where `docs` has
    them. The directory has about total / limit entries; it is joined, never collected.
    """
    bytes_name, *names = fresh(docs, "n_bytes", "shard", "shard_bytes", "shard_docs")
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.struct(*own).alias("row"),
        F.coalesce(F.col(size) if isinstance(size, str) else size, F.lit(0)).cast("long").alias("bytes"),
        hash_bits(F.col(doc_id)).alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
        F.lit("").alias("_base"),
    )
    rows = materialize(rows, "rows")
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    done, used, number = [], 0, 0
    depth = min(BITS, max(1, math.ceil(math.log2(max(1, total / limit_bytes)))) + round_bits)
    while True:
        rows = rows.withColumn("_leaf", F.expr(f"shiftright(_hash, {BITS - used - depth}) & {(1 << depth) - 1}L"))
        found, left = directory(rows, used or number, depth, limit_bytes)
        done.append(rows.join(found, ["_base", "_leaf"]))
        if number > 1 or left.isEmpty():
            break
        bits = F.concat("_base", F.expr(f"right(concat(repeat('0', 60), bin(_leaf)), {depth})"))
        rows = rows.join(left, ["_base", "_leaf"], "left_semi").withColumn("_base", bits).drop("_leaf")
        used += depth
        if used == BITS:  # the id's bits are used up: rows that repeat it differ by their number alone
            rows, used, number = rows.withColumn("_hash", hash_bits(F.col("_row"))), 0, number + 1
        rows, depth = materialize(rows, "rows"), min(BITS - used, 12)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(
        "row.*",
        F.col("bytes").alias(bytes_name),
        *[F.col(c).alias(n) for c, n in zip(("shard", "shard_bytes", "shard_docs"), names)],
    )
