"""Exact Jaccard join of documents on word shingles, as a metric-space join around elected pivots.

Jaccard distance is a metric, but documents that share nothing all lie at distance 1 from each other, so pivots drawn
at random separate nothing. Pivots are therefore elected by what documents share:

1. A document's prefix is its (1 - t) part of rarest shingles; two documents with similarity t or more share a prefix
   shingle. Any fixed order of shingles is right; rarest first, by a sketch of counts over all documents, makes shared ones few. The first class of equal documents that
   holds a shingle in its prefix becomes that shingle's pivot. A pivot's Voronoi region holds every document that elected it; a
   document which several pivots claim is replicated to each of their regions, so each linked pair meets in some region.
2. In a region, distances to the pivot are computed once. Documents within the radius r = 1 - t link to the pivot
   and need no further comparing with each other. The others compare with documents in their triangle-inequality window
   |d(x, p) - d(y, p)| <= r, and only across components that are not connected yet.
   Before that, documents whose profiles (shingle counts by hash class, whose distance never exceeds the documents' own) are
   too far from every other of the region leave it, so that whole sets are fetched for few, and what is left in groups is compared once.
3. A region above `region_docs` documents or `region_bytes` of sets is joined recursively. Its pivot becomes the set of the shingles
   that at least half of its documents hold, and documents are written as their differences D to it. Sets link when
   (100 + percent) |x - y| <= (100 - percent) (|x| + |y|) in differing elements, and |x - y| = |Dx| + |Dy| - 2 |Dx & Dy|; so with
   slack(x) = (100 - percent) |x| - (100 + percent) |Dx|, documents link at once where their slacks add up to 0 or more: all that
   can do so link to the document with the largest slack. Every other link shares elements of both differences, so
   prefixes of the differences form the next regions. No element is in more than half of the differences, so regions
   halve at each level.

Links are kept as a spanning set: each true link is an edge or its ends are connected by edges. Components are then
found by distributed star steps (`components.py`).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import chunks, find_words, hash_words, inside_one, list_array, materialize, roll
from lakekit.llm.components import components

BIN_BITS = 24  # bins of the shingle count sketch; two bits each, 4 MB in every Python worker
RANGE_BITS = 6  # the sketch is counted in so many ranges, one task each
FLUSH = 4 << 20  # shingles that a task counts together
CLASSES = 128, 4096  # hash classes of a document's profile, two bytes each: least and most


def shingle_sets(data, offsets, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, one after another, and their n + 1 offsets."""
    w = find_words(data, offsets, lower=True)
    h = hash_words(w)
    n = len(offsets) - 1
    at = inside_one(w, k)
    values, docs = [roll(h, k)[at]], [w.doc[at]]
    for short in range(1, k):  # a shorter document is one shingle
        few = np.flatnonzero(w.count == short)
        if len(few):
            values.append(roll(h, short)[w.first[few]])
            docs.append(few)
    value, doc = np.concatenate(values), np.concatenate(docs)
    if len(values) > 1:
        order = np.argsort(doc, kind="stable")
        value, doc = value[order], doc[order]
    bounds = np.searchsorted(doc, np.arange(n + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=n))])


def _bins(text: str, k: int):
    """(range, block) of a task's shingles, once for each document: compressed gaps between their sorted bins."""
    inner = np.uint64(64 - BIN_BITS)

    def pack(parts):
        bins = np.sort((np.concatenate(parts) >> inner).astype(np.int64))
        part = bins >> (BIN_BITS - RANGE_BITS)
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        low = bins & ((1 << (BIN_BITS - RANGE_BITS)) - 1)
        blocks = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            gaps = np.diff(low[a:b], prepend=0)
            wide = gaps > 254
            raw = np.where(wide, 255, gaps).astype(np.uint8).tobytes() + gaps[wide].astype(np.uint32).tobytes()
            blocks.append(np.array([b - a, len(raw)], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True))
        return pa.record_batch({"range": part[cuts[:-1]], "block": pa.array(blocks, pa.binary())})

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for _, data, offsets in chunks(batch, text):
                parts.append(shingle_sets(data, offsets, k)[0])
                size += len(parts[-1])
                if size >= FLUSH:
                    yield pack(parts)
                    parts, size = [], 0
        if size:
            yield pack(parts)

    return run


def _levels(table: pa.Table) -> pa.Table:
    """Two bits for each bin of a range: 0 for a single shingle, then by how far the count is above the mean."""
    counts = np.zeros(1 << (BIN_BITS - RANGE_BITS), np.int64)
    for block in table.column("block").to_pylist():
        n, size = np.frombuffer(block, np.int64, 2).tolist()
        raw = pa.decompress(block[16:], decompressed_size=size, codec="zstd", asbytes=True)
        gaps = np.frombuffer(raw, np.uint8, n).astype(np.int64)
        gaps[gaps == 255] = np.frombuffer(raw, np.uint32, offset=n)
        counts += np.bincount(np.cumsum(gaps), minlength=len(counts))
    mean = counts.mean()
    level = np.digitize(counts, [2, 2 * mean + 3, 16 * mean + 16]).astype(np.uint8).reshape(-1, 4)
    packed = level[:, 0] | (level[:, 1] << 2) | (level[:, 2] << 4) | (level[:, 3] << 6)
    return pa.table({"range": pa.array([table.column("range")[0].as_py()]), "levels": pa.array([packed.tobytes()], pa.binary())})


class Order:
    """Rarest-first order of shingles: by level, then by hash."""

    def __init__(self, ranges: pa.Table):
        self.levels = np.zeros(1 << (BIN_BITS - 2), np.uint8)
        size = len(self.levels) >> RANGE_BITS
        for at, levels in zip(ranges.column("range").to_pylist(), ranges.column("levels").to_pylist()):
            self.levels[at * size : (at + 1) * size] = np.frombuffer(levels, np.uint8)

    def level(self, s: np.ndarray) -> np.ndarray:
        at = s >> np.uint64(64 - BIN_BITS)
        return (self.levels[at >> np.uint64(2)] >> ((at & np.uint64(3)) << np.uint64(1)).astype(np.uint8)) & np.uint8(3)


class AnyOrder:
    """Shingles by hash alone."""

    def level(self, s: np.ndarray) -> np.ndarray:
        return np.zeros(len(s), np.uint8)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _need(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def _width(size: np.ndarray) -> np.ndarray:
    """Classes in the profile of a set: a power of two, at about 16 shingles each, where profiles of unrelated sets still differ."""
    return (1 << np.ceil(np.log2(np.clip(size / 16, *CLASSES))).astype(np.int64)).astype(np.int64)


def _features(doc_id: str, text: str, k: int, percent: int, order):
    """(doc_id, text_id, n_shingles, digest, class, profile, prefix) for each document."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                s, at = shingle_sets(data, offsets, k)
                level = order.value.level(s)
                prefix, digest, size = [], [], np.diff(at)
                doc = np.repeat(np.arange(len(size)), size)
                width = _width(size)
                first = np.cumsum(width) - width
                counts = np.bincount(first[doc] + (s.astype(np.int64) & (width[doc] - 1)), minlength=width.sum())
                counts = np.minimum(counts, 0xFFFF).astype(np.uint16)
                profile = [counts[a : a + w].tobytes() for a, w in zip(first, width)]
                for a, b in zip(at[:-1], at[1:]):
                    own, n = s[a:b], int(b - a)
                    digest.append(_digest(own) if n else None)
                    rank = np.argsort(level[a:b], kind="stable")[: n - _need(n, percent) + 1]
                    prefix.append(own[rank])
                lengths = np.array([len(p) for p in prefix], np.int64)
                values = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
                yield pa.record_batch(
                    {
                        "doc_id": part.column(doc_id).cast(pa.int64()),
                        "text_id": part.column("text_id"),
                        "n_shingles": size.astype(np.int64),
                        "digest": pa.array(digest, pa.binary()),
                        "class": pa.array([d and int.from_bytes(d[:8], "little", signed=True) for d in digest], pa.int64()),
                        "profile": pa.array(profile, pa.binary()),
                        "prefix": list_array(values.view(np.int64), lengths),
                    }
                )

    return run


def _sets(doc_id: str, text: str, k: int):
    """(digest, rep, items) of the documents that stand for their classes."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                s, at = shingle_sets(data, offsets, k)
                sets = [s[a:b] for a, b in zip(at[:-1], at[1:])]
                yield pa.record_batch(
                    {
                        "digest": pa.array([_digest(x) for x in sets], pa.binary()),
                        "rep": part.column(doc_id).cast(pa.int64()),
                        "items": pa.array([x.tobytes() for x in sets], pa.binary()),
                    }
                )

    return run


def _linked(inter, n, m, percent: int):
    return 100 * inter >= percent * (n + m - inter)


def region_edges(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning set of the links of one region; its first document is the pivot."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    starts = np.cumsum(size) - size
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges = []

    def link(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            edges.append((ids[i], ids[j]))

    mark = np.zeros(len(code) + 1, bool)

    def shared(i: int) -> np.ndarray:
        own = code[starts[i] : starts[i] + size[i]]
        mark[own] = True
        out = np.add.reduceat(mark[code].astype(np.int32), starts)
        mark[own] = False
        return out

    inter = shared(0)
    near = _linked(inter, size, size[0], percent)
    for j in np.flatnonzero(near):
        link(0, int(j))
    distance = 1 - inter / (size + size[0] - inter)
    window = 1 - percent / 100 + 1e-9
    for i in np.flatnonzero(~near):
        i = int(i)
        mine = find(i)
        wanted = np.abs(distance - distance[i]) <= window
        wanted &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
        wanted[i] = False
        around = [j for j in np.flatnonzero(wanted).tolist() if find(j) != mine]
        if around:
            inter = shared(i)
            for j in around:
                if _linked(int(inter[j]), int(size[j]), int(size[i]), percent):
                    link(i, j)
    return edges


def _join_region(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("rep", "ascending"), ("digest", "ascending")])
        ids = rows.column("rep").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("items").to_pylist()]
        edges = region_edges(ids, sets, percent)
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return run


def _may_link(percent: int):
    """(region, digest) of the documents of a region that may link to each other, by profiles alone, one region for each group of them.

    Profiles count shingles by hash class, so the sum of class minima is at least the intersection: distance between profiles never
    exceeds the documents' own, and nothing that links is lost. A class count at its limit of 65535 proves nothing and passes.
    Groups are named by their members, so that a group which several pivots brought together is compared once.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_shingles", "ascending")])
        size = table.column("n_shingles").to_numpy()
        digests = table.column("digest").to_pylist()
        profiles = [np.frombuffer(x, np.uint16).astype(np.uint32) for x in table.column("profile").to_pylist()]
        full = np.array([(p == 0xFFFF).any() for p in profiles])
        width = np.array([len(p) for p in profiles])
        group = np.arange(len(size))
        last = np.searchsorted(size, size * 100 // percent, side="right")
        start = at = 0
        for i in range(len(size)):
            if width[i] != at:  # larger sets have wider profiles, which are folded to those of the sets at hand
                start, at = i, int(width[i])
                end = last[np.searchsorted(width, at, side="right") - 1]
                profile = np.stack([p.reshape(-1, at).sum(0, dtype=np.uint32) for p in profiles[start:end]])
            others = np.arange(i + 1, last[i])
            others = others[group[others] != group[i]]
            if not len(others):
                continue
            most = np.minimum(profile[others - start], profile[i - start]).sum(1, dtype=np.int64)
            most[full[others] | full[i]] = size[i]
            near = others[_linked(most, size[others], size[i], percent)]
            if len(near):
                group[np.isin(group, group[near])] = group[i]
        regions, members = [], []
        for one in np.flatnonzero(np.bincount(group, minlength=len(size)) > 1):
            own = sorted(digests[i] for i in np.flatnonzero(group == one))
            name = hashlib.blake2b(b"".join(own), digest_size=8).digest()
            regions += [int.from_bytes(name, "little", signed=True)] * len(own)
            members += own
        return pa.table({"region": pa.array(regions, pa.int64()), "digest": pa.array(members, pa.binary())})

    return run


def _items(batches):
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column("items").to_pylist()]
        lengths = np.array([len(s) for s in sets], np.int64)
        yield pa.record_batch(
            {
                "region": batch.column("region").take(pa.array(np.repeat(np.arange(len(sets)), lengths))),
                "token": np.concatenate(sets) if sets else np.zeros(0, np.int64),
            }
        )


def _differences(percent: int, order):
    """For (region, digest, rep, items, centre): the slack, and the difference to the centre in order."""

    def run(batches):
        for batch in batches:
            slack, deltas = [], []
            for x, c in zip(batch.column("items").to_pylist(), batch.column("centre")):
                x, c = np.frombuffer(x, np.uint64), np.asarray(c.values).astype(np.int64).view(np.uint64)
                d = np.setxor1d(x, c, assume_unique=True)
                deltas.append(d[np.argsort(order.value.level(d), kind="stable")].view(np.int64))
                slack.append((100 - percent) * len(x) - (100 + percent) * len(d))
            lengths = np.array([len(d) for d in deltas], np.int64)
            yield pa.record_batch(
                {
                    "region": batch.column("region"),
                    "digest": batch.column("digest"),
                    "rep": batch.column("rep"),
                    "slack": pa.array(slack, pa.int64()),
                    "delta": list_array(np.concatenate(deltas) if deltas else np.zeros(0, np.int64), lengths),
                }
            )

    return run


def _split(crowded: DataFrame, percent: int, order) -> tuple[DataFrame, DataFrame]:
    """Links found at once in (region, digest, rep, items), and the (region, digest) of the next level."""
    sizes = crowded.groupBy("region").agg(F.count("*").alias("docs"))
    centres = (
        crowded.select("region", "items")
        .mapInArrow(_items, "region long, token long")
        .groupBy("region", "token")
        .agg(F.count("*").alias("n"))
        .join(sizes, "region")
        .where("2 * n >= docs")
        .groupBy("region")
        .agg(F.collect_list("token").alias("centre"))  # at most twice the mean set
    )
    rows = materialize(
        crowded.join(centres, "region", "left")
        .withColumn("centre", F.coalesce("centre", F.array().cast("array<bigint>")))
        .select("region", "digest", "rep", "items", "centre")
        .mapInArrow(_differences(percent, order), "region long, digest binary, rep long, slack long, delta array<long>"),
        "differences",
    )
    best = rows.groupBy("region").agg(F.max("slack").alias("most"), F.max_by("rep", F.struct("slack", "rep")).alias("hub"))
    rows = rows.join(best, "region").withColumn("near", F.expr("slack + most >= 0"))
    links = rows.where("near and rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    shared = F.when(F.col("near"), 1).otherwise(F.ceil(-(F.col("slack") + F.col("most")) / (2 * (100 + percent))))
    keep = (F.greatest(F.lit(0), F.size("delta") - F.greatest(F.lit(1), shared) + 1)).cast("int")
    tokens = materialize(
        rows.select("region", "digest", "near", F.explode(F.slice("delta", F.lit(1), keep)).alias("token")), "tokens"
    )
    # Elements with the same documents form one region; a group whose documents are all near the centre has no open pair.
    groups = (
        tokens.groupBy("region", "token")
        .agg(
            F.count("*").alias("n"),
            F.bool_and("near").alias("closed"),
            F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("members"),
        )
        .where("n > 1 and not closed")
        .select("region", "token", F.xxhash64("region", "n", "members").alias("next"))
    )
    deeper = tokens.join(groups, ["region", "token"]).select(F.col("next").alias("region"), "digest").distinct()
    return links, materialize(deeper, "level")


def _elect(tokens: DataFrame) -> DataFrame:
    """(region, class): the classes that elected one pivot by a shared token, and the pivot."""
    chosen = tokens.groupBy("token").agg(F.min("class").alias("pivot"), F.max("class").alias("last")).where("pivot <> last")
    # The pivot's own row of each token puts it in its region too.
    return (
        tokens.join(chosen.drop("last").hint("merge"), "token").select(F.col("pivot").alias("region"), "class").distinct()
    )


def link_regions(
    level: DataFrame, sets: DataFrame, percent: int, region_docs: int, region_bytes: int, order=None
) -> list[DataFrame]:
    """Frames of links (a, b) that together connect what links within the regions of `level(region, digest)`, by the full
    `sets(digest, rep, items)`. Regions above the limits are split until they fit. `order` (a broadcast Order) is for speed only."""
    order = order or level.sparkSession.sparkContext.broadcast(AnyOrder())
    edges = []
    while True:
        members = level.join(sets.hint("merge"), "digest")
        sizes = materialize(
            level.join(sets.select("digest", F.length("items").alias("size")), "digest")
            .groupBy("region")
            .agg((F.count("*") > region_docs).alias("over"), F.sum("size").alias("bytes"))
            .select("region", F.expr(f"over or bytes > {region_bytes}").alias("large")),
            "sizes",
        )
        whole = members.join(sizes.where("not large"), "region", "left_semi")
        edges.append(whole.groupBy("region").applyInArrow(_join_region(percent), "a long, b long"))
        large = sizes.where("large")
        if large.isEmpty():
            return edges
        links, level = _split(members.join(large, "region", "left_semi"), percent, order)
        edges.append(links)


def jaccard_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    region_docs: int = 4096,
    region_bytes: int = 64 << 20,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs`.

    A document's set is its distinct shingles of `shingle_words` words (ASCII letters in lower case, split at ASCII white space);
    a document with fewer words is one shingle; with none its set is empty and links with nothing. Two documents link when
    100 * |intersection| >= percent * |union|, and component_id is the smallest doc_id that links reach.

    Null or blank texts have the empty set and are their own component. Rows with a null doc_id are returned with a null
    component and link with nothing. Rows that repeat a doc_id are one node: each row is returned, with that node's
    component. Other columns are not read. Exact copies meet as one class by the digest of their set, never as pairs.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_id"))
    levels = (
        docs.select("text")
        .mapInArrow(_bins("text", shingle_words), "range long, block binary")
        .groupBy("range")
        .applyInArrow(_levels, "range long, levels binary")
    )
    order = spark.sparkContext.broadcast(Order(levels.toArrow()))
    features = materialize(
        docs.mapInArrow(
            _features("doc_id", "text", shingle_words, percent, order),
            "doc_id long, text_id long, n_shingles long, digest binary, class long, profile binary, prefix array<long>",
        ),
        "shingles",
    )
    known = features.where("doc_id is not null and n_shingles > 0")
    # Copies are one class: any of them has its profile, and the row with the smallest id stands for it. Should two classes share
    # a number, both enter the regions of either, which loses nothing. Regions hold classes, not ids: an id may have very many.
    alike = [F.first(c).alias(c) for c in ("class", "n_shingles", "profile")]
    least = F.min(F.struct("doc_id", "text_id")).alias("least")
    classes = known.groupBy("digest").agg(least, *alike).select("digest", "least.*", "class", "n_shingles", "profile")
    classes = materialize(classes.withColumnRenamed("doc_id", "rep"), "classes")
    copies = (
        known.select("digest", "doc_id")
        .join(classes.select("digest", "rep"), "digest")
        .where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    elected = materialize(_elect(known.select("class", F.explode("prefix").alias("token"))), "elected")
    crowds = elected.groupBy("region").agg((F.count("*") > region_docs).alias("large"))
    # Nothing below has a proven size, so no side of these joins is to be broadcast at any size.
    placed = elected.join(crowds.hint("merge"), "region").join(classes.drop("rep", "text_id").hint("merge"), "class")
    near = (
        placed.where("not large")
        .select("region", "digest", "n_shingles", "profile")
        .groupBy("region")
        .applyInArrow(_may_link(percent), "region long, digest binary")
        .distinct()
    )
    far = placed.where("large").select("region", "digest")
    level = materialize(near.unionByName(far), "level")
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
    for more in link_regions(level, sets, percent, region_docs, region_bytes, order):
        linked = linked.unionByName(more)
    found = components(linked)
    return (
        features.select("doc_id", "n_shingles")
        .join(found, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
