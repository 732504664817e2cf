"""Near duplicates by fast similarity sketching, banding and exact verification.

1. A sketch has t coordinates and is filled in rounds: in round i every element is hashed to one coordinate and puts the value (i, hash) there
   if that is the smallest so far. What is still empty after t rounds is filled by t more, in which round t + j gives all
   elements to coordinate j. So every coordinate is filled, even from one element, a set of n costs O(n + t log t), and coordinates
   of two sets agree with probability J each, with the concentration of independent samples.
2. Bands of `BAND_ROWS` coordinates are bucket keys. Two sets at the threshold J = 0.85 miss all 32 bands of 4 with
   probability (1 - 0.85^4)^32 = 6e-11. Buckets with the same smallest member are one region, so that a set is not sent once for each band.
3. Sets whose sketches agree with no other in their region in at least `agree` coordinates leave it before whole sets are fetched; a pair
   at the threshold falls short of 80 of 128 with probability below 1e-10.
4. Regions are verified on full sets (`ngram_jaccard.link_regions`): exact intersections, and regions with too many sets for one task
   are split further by their differences to a centre, at any size.

Exact copies are one class by the digest of their set, and never meet as pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import chunks, list_array, materialize, mix
from lakekit.llm.components import components
from lakekit.llm.ngram_jaccard import _digest, _elect, _linked, _sets, link_regions, shingle_sets

COORDINATES = 128  # a power of two
BANDS, BAND_ROWS = 32, 4
AGREE = 80  # coordinates that a pair's sketches share before its sets are compared

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * _ODD  # of the rounds
_VALUE_BITS = np.uint64(55)  # below the round's number, which is less than 2 * COORDINATES


def sketches(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The filled sketch (a row of COORDINATES values) of each set; sets are hashes, one after another. An empty set has an empty sketch."""
    t, n = COORDINATES, len(offsets) - 1
    sizes = np.diff(offsets)
    flat = np.full(n * t, _EMPTY)
    doc = np.repeat(np.arange(n), sizes)
    items, left = sets, t * (sizes > 0)  # coordinates yet to fill
    for i in range(2 * t):
        open_docs = left > 0
        if not open_docs.any():
            break
        live = open_docs[doc]
        if not live.all():
            items, doc = items[live], doc[live]
        h = mix(items ^ _SEEDS[i])
        at = (h & np.uint64(t - 1)).astype(np.int64) if i < t else np.full(len(h), i - t)
        at += doc * t
        empty = flat[at] == _EMPTY  # a value of an earlier round is smaller than any of this one
        at, value = at[empty], (np.uint64(i) << _VALUE_BITS) | (h[empty] >> (np.uint64(64) - _VALUE_BITS))
        np.minimum.at(flat, at, value)
        left = left - np.bincount(np.unique(at) // t, minlength=n)
    return flat.reshape(n, t)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit bucket key for each band of each sketch."""
    parts = sketch.reshape(len(sketch), BANDS, BAND_ROWS)
    keys = np.broadcast_to(_SEEDS[:BANDS], parts.shape[:2])
    for j in range(BAND_ROWS):
        keys = mix(keys ^ parts[:, :, j]) * _ODD
    return keys


def _features(k: int):
    """(doc_id, text_id, n_shingles, digest, class, sketch, bands) for each document; a sketch's coordinates are cut to one byte."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                s, at = shingle_sets(data, offsets, k)
                sketch, size = sketches(s, at), np.diff(at)
                keys = band_keys(sketch)[size > 0]
                digest = [_digest(s[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:])]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").cast(pa.int64()),
                        "text_id": part.column("text_id"),
                        "n_shingles": size.astype(np.int64),
                        "digest": pa.array(digest, pa.binary()),
                        "class": pa.array([d and int.from_bytes(d[:8], "little", signed=True) for d in digest], pa.int64()),
                        "sketch": pa.array([x.tobytes() for x in sketch.astype(np.uint8)], pa.binary()),
                        "bands": list_array(keys.ravel().view(np.int64), BANDS * (size > 0)),
                    }
                )

    return run


def _alike(percent: int, agree: int):
    """The (region, digest) of a region whose sketch and size allow a link to another of its sets."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_shingles", "ascending")])
        size = table.column("n_shingles").to_numpy()
        sketch = np.stack([np.frombuffer(x, np.uint8) for x in table.column("sketch").to_pylist()])
        keep = np.zeros(len(size), bool)
        last = np.searchsorted(size, size * 100 // percent, side="right")
        for i in range(len(size)):
            others = slice(i + 1, last[i])
            if others.start >= others.stop or (keep[i] and keep[others].all()):
                continue
            same = (sketch[others] == sketch[i]).sum(1) >= agree
            same &= _linked(size[i], size[others], size[i], percent)  # the smaller set is the largest intersection
            if same.any():
                keep[i] = True
                keep[others] |= same
        return pa.table({"region": table.column("region"), "digest": table.column("digest")}).filter(pa.array(keep))

    return run


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    percent: int = 85,
    agree: int = AGREE,
    region_docs: int = 4096,
    region_bytes: int = 64 << 20,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs`.

    A document's set is its distinct shingles of `shingle_words` words (ASCII letters in lower case, split at ASCII white space), the
    whole sequence if it has fewer words, empty without words. Documents link when 100 * |intersection| >= percent * |union|, confirmed
    on full sets (of 64-bit shingle hashes); component_id is the smallest doc_id that links reach, and a document is kept if
    that is its own. BANDS, BAND_ROWS and `agree` suit thresholds of 85 percent and more; lower ones need more bands.

    Null, empty and blank texts have the empty set, link with nothing and are kept. Very long texts are sketched whole, a text at a
    time. Rows with a null doc_id link with nothing, have a null component and are kept, as no other row stands for them. Rows that
    repeat a doc_id are one node of the links; each is returned, with its own n_shingles, and all are kept or none. Ties between copies go to the smaller id. Other columns are not
    read; an empty table gives no rows.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("text_id"))
    schema = "doc_id long, text_id long, n_shingles long, digest binary, class long, sketch binary, bands array<long>"
    features = materialize(docs.mapInArrow(_features(shingle_words), schema), "sketches")
    known = features.where("doc_id is not null and n_shingles > 0")
    least = F.min(F.struct("doc_id", "text_id")).alias("least")
    classes = known.groupBy("digest").agg(least, *[F.first(c).alias(c) for c in ("class", "n_shingles", "sketch", "bands")])
    classes = classes.select("digest", F.col("least.doc_id").alias("rep"), F.col("least.text_id").alias("text_id"), "class", "n_shingles", "sketch", "bands")
    classes = materialize(classes, "classes")
    copies = (
        known.select("digest", "doc_id")
        .join(classes.select("digest", "rep"), "digest")
        .where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    # Nothing below has a proven size, so no side of these joins is to be broadcast.
    placed = materialize(_elect(classes.select("class", F.explode("bands").alias("token"))), "buckets")
    crowds = placed.groupBy("region").agg((F.count("*") > region_docs).alias("large"))
    placed = placed.join(crowds.hint("merge"), "region").join(classes.select("class", "digest", "n_shingles", "sketch").hint("merge"), "class")
    near = placed.where("not large").select("region", "digest", "n_shingles", "sketch")
    near = near.groupBy("region").applyInArrow(_alike(percent, agree), "region long, digest binary")
    level = materialize(near.unionByName(placed.where("large").select("region", "digest")), "candidates")
    wanted = classes.join(level.select("digest").distinct().hint("merge"), "digest", "left_semi")
    sets = materialize(
        docs.where("doc_id is not null")
        .join(wanted.select(F.col("rep").alias("doc_id"), "text_id").hint("merge"), ["doc_id", "text_id"], "left_semi")
        .dropDuplicates(["doc_id", "text_id", "text"])  # on the join's partitioning
        .mapInArrow(_sets("doc_id", "text", shingle_words), "digest binary, rep long, items binary")
        .where("length(items) > 0"),
        "sets",
    )
    linked = copies
    for more in link_regions(level, sets, percent, region_docs, region_bytes):
        linked = linked.unionByName(more)
    found = components(linked)
    return (
        features.select("doc_id", "n_shingles")
        .join(found, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.expr("doc_id is null or doc_id = component_id"))
    )
