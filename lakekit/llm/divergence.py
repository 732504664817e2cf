"""Divergence of sources: how far each (lang, source) group's word use is from every other group's and from its language's, exactly.

1. Tasks count terms by group with Arrow dictionaries; Spark adds the counts. A language keeps the terms of enough documents.
2. Kept terms get ids, their places in code-point order, from one range shuffle. A group's vector is a sorted (id, count) array, cut into
   blocks of ids, so that no array is longer than a block.
3. For each unordered pair of groups and each block, both arrays are co-grouped. Galloping searches of the shorter one's ids in the longer
   one find what they share; shared and one-sided terms are priced both ways in the task. Terms that neither has all cost the same, so
   they are counted and not visited: their number is the vocabulary less the united ids.

All arithmetic is on integers. A third of all rows in one group only makes counts larger: vectors hold at most the vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import ALNUM, LOWER, chunks, materialize, ranked

SCALE = 1_000_000_000  # the probability 1
BLOCK_BITS = 18  # term ids in a block
_BYTES = np.arange(256)
LETTERS = ALNUM & ~((_BYTES >= 0x30) & (_BYTES <= 0x39))


def _count_terms(batches):
    """(lang, source, term, n, docs): occurrences, and documents that hold the term, once for each few MB of text."""
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            inside = LETTERS[data]
            edge = np.zeros(len(data) + 1, bool)
            edge[offsets] = True
            before = np.zeros(len(data), bool)
            before[1:] = inside[:-1]
            start = np.flatnonzero(inside & (~before | edge[:-1]))
            if not len(start):
                continue
            # Letters alone, one after another, are the terms' bytes; each is whole UTF-8, as only ASCII parts them.
            at = np.cumsum(inside, dtype=np.int64)[start] - 1
            ends = np.append(at, int(inside.sum()))
            terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]]))
            coded = terms.dictionary_encode()
            code, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            doc = np.searchsorted(offsets, start, side="right") - 1
            groups = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"])
            keys = {}
            group = np.array([keys.setdefault((g["lang"], g["source"]), len(keys)) for g in groups.to_pylist()], np.int64)
            held = np.unique(doc * size + code)
            pair, docs = np.unique(group[held // size] * size + held % size, return_counts=True)
            n = np.bincount(np.searchsorted(pair, group[doc] * size + code), minlength=len(pair))
            names = list(keys)
            of = pa.array(pair // size)
            yield pa.record_batch(
                {
                    "lang": pa.array([k[0] for k in names], pa.string()).take(of),
                    "source": pa.array([k[1] for k in names], pa.string()).take(of),
                    "term": coded.dictionary.take(pa.array(pair % size)).cast(pa.string()),
                    "n": n.astype(np.int64),
                    "docs": docs.astype(np.int64),
                }
            )


def probability(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)) as a long, by long division in steps of 1000: exact for totals up to 9e15."""
    whole, left = "0L", f"({count} + 1)"
    for _ in range(3):
        whole, left = f"({whole} * 1000 + {left} * 1000 div ({total} + {terms}))", f"({left} * 1000 % ({total} + {terms}))"
    return F.expr(f"1 + {whole}")


def probabilities(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same for an array of counts."""
    whole, left = np.zeros(len(count), np.int64), count.astype(np.int64) + 1
    for _ in range(3):
        digit, left = np.divmod(left * 1000, total + terms)
        whole = whole * 1000 + digit
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """The place in sorted `long` of each of sorted `short`, -1 where it is not: windows double until they hold an id, then halve."""
    if not len(long):
        return np.full(len(short), -1, np.int64)
    if len(long) < 8 * len(short):  # most windows would be next to each other
        at = np.searchsorted(long, short)
    else:
        # Every 64th id narrows all searches to one stretch; the ids of `short` then gallop inside their stretches together.
        low = np.searchsorted(long[::64], short, side="right") - 1
        low = np.maximum(low, 0) * 64
        width = np.ones(len(short), np.int64)
        while True:
            end = np.minimum(low + width, len(long) - 1)
            more = (long[end] < short) & (end < len(long) - 1)
            if not more.any():
                break
            width[more] *= 2
        high = end
        while (low < high).any():
            middle = (low + high) // 2
            right = (long[middle] < short) & (low < high)
            low, high = np.where(right, middle + 1, low), np.where(right, high, middle)
        at = low
    at = np.minimum(at, len(long) - 1)
    return np.where(long[at] == short, at, -1)


def _total(values: np.ndarray) -> int:
    """The sum of non-negative longs beyond the range of a long."""
    return (int((values >> 32).sum()) << 32) + int((values & 0xFFFFFFFF).sum())


def merge_price(a: tuple, b: tuple, terms: int) -> tuple[int, int, int]:
    """(united ids, sum priced from a to b, from b to a) of two blocks (ids, counts, total of the group's counts)."""
    (ids, n, total), (other_ids, m, other_total) = a, b
    if len(ids) > len(other_ids):
        united, back, there = merge_price(b, a, terms)
        return united, there, back
    at = gallop(ids, other_ids)
    shared = at >= 0
    theirs = np.zeros(len(ids), np.int64)
    theirs[shared] = m[at[shared]]
    alone = np.ones(len(other_ids), bool)
    alone[at[shared]] = False
    count = np.concatenate([n, np.zeros(int(alone.sum()), np.int64)])
    other = np.concatenate([theirs, m[alone]])
    p, q = probabilities(count, total, terms), probabilities(other, other_total, terms)
    return len(count), _total(price(p, q)), _total(price(q, p))


_MERGED = "lang string, a string, b string, united long, there string, back string"


def _merge_block(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The two groups of a pair in one block of ids: one row on each side, or on one of them."""

    def vector(side: pa.Table, total: int) -> tuple:
        if not side.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), total
        ids, n = (side.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "n"))
        return ids, n, total

    row = {c: (left if left.num_rows else right).column(c)[0].as_py() for c in ("lang", "a", "b", "terms", "total_a", "total_b")}
    united, there, back = merge_price(vector(left, row["total_a"]), vector(right, row["total_b"]), row["terms"])
    out = {c: pa.array([row[c]], pa.string()) for c in ("lang", "a", "b")}
    out |= {"united": pa.array([united], pa.int64()), "there": pa.array([str(there)]), "back": pa.array([str(back)])}
    return pa.table(out)


def divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 3, top_terms: int = 200, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for each group of `docs`.

    Terms are runs of ASCII letters (lower-cased) and other code points beyond ASCII; a language keeps those of `min_docs` of its documents. p of a
    group and term is 1 + floor(SCALE * (count + 1) / (N + V)), with N the group's occurrences of the V kept terms, and the price of p
    against q is floor((p - q)^2 / q). Part `pair` has each other group of the language with the sum over all kept terms, q being
    that group's; part `term` the group's own terms that exceed the language's q, up to rank `top_terms`. Ranks go by value, highest
    first, ties by the item's UTF-8 bytes.

    Null text, lang and source count as empty. A group without terms has a uniform p; without kept terms in the language its pairs have
    the value 0. Repeated rows and repeated ids are documents of their own. Very long texts are counted whole, a text at a time, in the task
    that reads them. Other columns are not read; an empty table gives no rows.
    """
    read = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]
    docs = docs.select(*read)
    partial = docs.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    counts = materialize(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    by_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(f"docs >= {min_docs}")
    kept = materialize(ranked(materialize(by_term.drop("docs"), "kept"), ["lang"], ["term"], "id", "kept-sorted"), "terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("all_total"))
    own = materialize(counts.drop("docs").join(kept, ["lang", "term"]), "vectors")
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "all_total"])
    )
    groups = materialize(groups, "groups")
    by_value = [F.desc("value"), F.asc("item")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value))

    priced = own.join(groups, ["lang", "source"])  # not by lang alone, which may be one for most rows
    priced = priced.withColumn("p", probability("n", "total", "terms")).withColumn("q", probability("all_n", "all_total", "terms"))
    terms = (
        priced.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= top_terms)
    )

    # An array is at most 2^block_bits entries long, whatever the group.
    arrays = own.groupBy("lang", "source", F.shiftright("id", block_bits).alias("block"))
    arrays = arrays.agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("v"))
    arrays = materialize(arrays.select("lang", "source", "block", F.col("v.id").alias("ids"), F.col("v.n").alias("n")), "arrays")

    one = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "terms")
    two = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = materialize(one.join(two, "lang").where("a < b"), "pairs")  # each is two rows of the result

    def side(name: str) -> DataFrame:
        rows = pairs.join(arrays.withColumnRenamed("source", name), ["lang", name])
        # Aliases make both sides' columns different ones for the co-grouping.
        return rows.select(*[F.col(c).alias(c) for c in rows.columns]).groupBy("lang", "a", "b", "block")

    big = "decimal(38,0)"
    merged = side("a").cogroup(side("b")).applyInArrow(_merge_block, _MERGED).groupBy("lang", "a", "b")
    merged = merged.agg(F.sum("united").alias("united"), F.sum(F.col("there").cast(big)).alias("there"), F.sum(F.col("back").cast(big)).alias("back"))
    none = "({p} - {q}) * ({p} - {q}) div {q}"
    found = pairs.join(merged, ["lang", "a", "b"], "left").na.fill(0, ["united"])
    found = found.withColumn("p", F.when(F.col("terms") > 0, probability("0", "total_a", "terms")))
    found = found.withColumn("q", F.when(F.col("terms") > 0, probability("0", "total_b", "terms")))

    def value(total: str, p: str, q: str) -> Column:
        both = F.expr(f"coalesce({total}, 0) + cast(terms - united as {big}) * ({none.format(p=p, q=q)})")
        return F.when(F.col("terms") > 0, both).otherwise(0).cast("long").alias("value")

    directed = found.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value("there", "p", "q")).unionByName(
        found.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), value("back", "q", "p"))
    )
    ranked_pairs = directed.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", rank)
    return ranked_pairs.unionByName(terms)
