"""Mixing sources to target weights, by Sainte-Lague apportionment of equal-token blocks; built-in expressions only.

Quotas are integer numbers of words, the equal blocks that are apportioned, so that sources of a few words get theirs too. Sources get them
by highest quotients target / (2k - 1); a source's quota goes to its shards the same way, by size. Shards hold about
`shard_words` words each, whatever the source's size, so the window over a shard's documents is over a bounded number of words. A shard's
documents, in a seeded order, form one stream cut into blocks of `block_words` words, the last one shorter. Its quota is whole passes
over all blocks and one more of some blocks, picked by a seeded permutation (a prime step modulo the number of blocks) and weighted by
their words; the last one picked is cut where the quota ends. So each document's share follows from its place in the stream alone,
no block is ever a row, and a shard gives exactly its quota.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import NOT_SPACE_RE, fresh, materialize

#: Steps of the block permutation, primes above any usual number of blocks in a shard.
STEPS = (1000003, 998244353, 1000000007, 2147483647)


def count_words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE_RE)), F.lit(0)).cast("long")


def apportion(rows: DataFrame, groups: list[str], weight: str, seats: str, order: list[str], quota: str) -> DataFrame:
    """`rows` with `quota`: each group's `seats` given by the highest quotients weight / (k - 1/2), ties by `order`.

    The quotients of all but about one seat for each row are sure: with S rows, what rounding gives for seats - S/2 is granted
    to all, and what it gives for seats + S/2 is enough. Only the quotients between are sorted, about as many as rows.
    """
    all_of = Window.partitionBy(*groups)
    rows = rows.withColumn("_n", F.count(F.when(F.col(weight) > 0, 1)).over(all_of)).withColumn("_w", F.sum(weight).over(all_of))
    ideal = F.when(F.col("_w") > 0, F.col(weight) / F.col("_w")).otherwise(0.0)

    def rounded(given: Column) -> Column:
        return F.floor(F.greatest(F.lit(0.0), given) * F.col("_x") + 0.5).cast("long")

    rows = (
        rows.withColumn("_x", ideal)
        .withColumn("_low", rounded(F.col(seats) - F.col("_n") / 2))
        .withColumn("_high", F.greatest("_low", rounded(F.col(seats) + F.col("_n") / 2 + 1)))
        .withColumn("_open", F.col(seats) - F.sum("_low").over(all_of))
    )
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("_q"), *order))
    won = (
        rows.where("_high > _low")
        .select(*groups, *[c for c in order if c not in groups], "_x", "_open", F.explode(F.sequence(F.col("_low") + 1, "_high")).alias("_k"))
        .withColumn("_q", F.col("_x") / (F.col("_k") - 0.5))
        .withColumn("_place", place)
        .where("_place <= _open")
        .groupBy(*groups, *[c for c in order if c not in groups])
        .agg(F.count("*").alias("_won"))
    )
    keys = list(dict.fromkeys([*groups, *order]))
    return (
        rows.join(won, keys, "left")
        .withColumn(quota, F.col("_low") + F.coalesce("_won", F.lit(0)))
        .drop("_n", "_w", "_x", "_low", "_high", "_open", "_won")
    )


def source_targets(sizes: DataFrame, percent: int, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size) with `_at` (place by code point, null last) and `target` in words.

    Targets are in proportion to the repeating weights, together `percent` of all sizes; what a source cannot take beyond `most`
    times its size goes to the others by weight. Taken in the order of size / weight, a source is at its limit exactly if
    an equal share of what is left, after those before it, would exceed it.
    """
    one = Window.partitionBy(F.lit(0))
    values = F.array(*[F.lit(float(w)) for w in weights])
    placed = sizes.withColumn("_at", F.row_number().over(one.orderBy(F.asc_nulls_last("source"))))
    placed = (
        placed.withColumn("_weight", F.element_at(values, ((F.col("_at") - 1) % len(weights) + 1).cast("int")))
        .withColumn("_most", F.col("source_size") * F.lit(float(most)))
        .withColumn("_all", F.sum("source_size").over(one) * (percent / 100))
        .withColumn("_weights", F.sum("_weight").over(one))
    )
    before = one.orderBy(F.col("_most") / F.col("_weight"), "_at").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_all") - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    share = left / (F.col("_weights") - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    placed = placed.withColumn("_share", share).withColumn("_full", F.col("_most") <= F.col("_share") * F.col("_weight"))
    level = F.max(F.when(~F.col("_full"), F.col("_share"))).over(one)
    target = F.when(F.col("_full"), F.col("_most")).otherwise(level * F.col("_weight"))
    return placed.withColumn("target", target).select("source", "source_size", "_at", "target")


def plan_mix(
    rows: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
    tie: str = "tie",
    percent: int = 150,
    weights: tuple[int, ...] = (3, 1, 2),
    most: int = 2,
    block_words: int = 64,
    shard_words: int = 1 << 20,
    seed: int = 17,
) -> DataFrame:
    """`rows` with source_size, target, passes, first_word, extra_blocks, part_words, blocks, step, shift and taken.

    `rows` is read more than once and should be stored. `taken` is the number of words that the mix takes of a document: `passes` whole
    ones, and the overlap with the `extra_blocks` that are picked once more and the first `part_words` of the next. It never exceeds `most` sizes. Documents without
    words take nothing; a null source is a source, the last; rows that repeat an id and text are ordered at will, which gives
    the same set of results. Sources without words have the target 0.
    """
    totals = rows.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = source_targets(totals, percent, weights, most)
    seats = F.round(F.sum("target").over(Window.partitionBy(F.lit(0)))).cast("long")
    quotas = apportion(targets.withColumn("_all", F.lit(0)).withColumn("_seats", seats), ["_all"], "target", "_seats", ["_at"], "_quota")
    quotas = quotas.drop("_all", "_seats").withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)))
    placed = (
        rows.join(quotas, rows[source].eqNullSafe(quotas["source"]), "left").drop(quotas["source"])
        .withColumn("_order", F.xxhash64(F.lit(seed), doc_id, tie))
        .withColumn("_shard", F.pmod("_order", "_shards"))
    )
    shards = placed.groupBy("_at", "_shard", "_quota").agg(F.sum(size).alias("_words"))
    shards = apportion(shards, ["_at"], "_words", "_quota", ["_shard"], "_got").drop("_quota")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_words") / block_words)).cast("long")
    mark = F.xxhash64(F.lit(seed), "_at", "_shard")
    steps = F.array(*[F.lit(s).cast("long") for s in STEPS])
    whole = F.greatest("_words", F.lit(1))
    shards = (
        shards.withColumn("blocks", blocks)
        .withColumn("_got", F.least("_got", F.col("_words") * most))
        .withColumn("passes", F.expr("_got div greatest(_words, 1L)"))
        .withColumn("_rest", F.col("_got") - F.col("passes") * whole)
        .withColumn("step", F.element_at(steps, (F.pmod(mark, F.lit(len(STEPS))) + 1).cast("int")))
        .withColumn("shift", F.pmod(F.shiftright(mark, 8), "blocks"))
        # Words picked before the short last block; once that is picked whole, the rest counts as if it were full.
        .withColumn("_ahead", F.expr(f"pmod((blocks - 1) * step + shift, blocks) * {block_words}"))
        .withColumn("_short", F.expr(f"blocks * {block_words} - _words"))
        .withColumn("_rest", F.expr(f"IF(_rest - _ahead >= {block_words} - _short, _rest + _short, _rest)"))
        .withColumn("extra_blocks", F.expr(f"_rest div {block_words}"))
        .withColumn("part_words", F.expr(f"_rest % {block_words}"))
        .drop("_got", "_words", "_rest", "_ahead", "_short")
    )
    stream = Window.partitionBy("_at", "_shard").orderBy("_order", doc_id, tie).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.drop("_quota", "_shards")
        .withColumn("first_word", F.sum(size).over(stream) - F.col(size))
        .join(shards, ["_at", "_shard"])
        .withColumn("taken", F.col("passes") * F.col(size) + F.expr(_extra_words(size, block_words)))
        .drop("_at", "_shard", "_order")
    )


def _span(size: str, block: int) -> tuple[str, str, str]:
    """SQL of the blocks that a document meets, of its first word in block j and of how many from there are picked once more."""
    end = f"(first_word + `{size}`)"
    blocks = f"sequence(first_word div {block}, ({end} - 1) div {block})"
    place = "pmod(j * step + shift, blocks)"
    picked = f"CASE WHEN {place} < extra_blocks THEN {block} WHEN {place} = extra_blocks THEN part_words ELSE 0 END"
    first = f"greatest(j * {block}, first_word)"
    return blocks, first, f"greatest(0, least({end}, j * {block} + {picked}) - {first})"


def _extra_words(size: str, block: int) -> str:
    blocks, _, words = _span(size, block)
    return f"CASE WHEN `{size}` > 0 AND extra_blocks + part_words > 0 THEN aggregate({blocks}, 0L, (acc, j) -> acc + {words}) ELSE 0L END"


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block_words: int = 64, **options) -> DataFrame:
    """The mixed documents, with the columns of `docs`: a row for each whole pass, and one with the words of the blocks that are picked
    once more (joined by single spaces, unless they are the whole text). Documents of which the mix takes nothing are left out."""
    size, tie, pieces = fresh(docs, "size", "tie", "pieces")
    rows = docs.withColumn(size, count_words(F.col(text))).withColumn(tie, F.xxhash64(text))
    planned = plan_mix(materialize(rows, "sizes"), doc_id, source, size, tie, block_words=block_words, **options)
    blocks, first, n = _span(size, block_words)
    words = f"regexp_extract_all(`{text}`, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    # The words are bound once, as w, and not split anew for each block.
    part = (
        f"element_at(transform(array({words}), w -> array_join(flatten(transform({blocks}, j -> "
        f"slice(w, CAST({first} - first_word + 1 AS INT), CAST({n} AS INT)))), ' ')), 1)"
    )
    rest = f"taken - passes * `{size}`"
    whole = F.expr(f"array_repeat(`{text}`, CAST(passes + IF({rest} = `{size}`, 1, 0) AS INT))")
    some = F.expr(f"IF({rest} > 0 AND {rest} < `{size}`, array({part}), CAST(array() AS array<string>))")
    out = planned.where("taken > 0").withColumn(pieces, F.concat(whole, some))
    return out.select(*[F.explode(pieces).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
