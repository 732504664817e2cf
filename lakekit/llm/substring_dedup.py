"""Removal of repeated word passages, found by super-k-mer partitioning.

Every window of 13 words belongs to the bucket of its minimiser, the smallest hash of its runs of four words. Consecutive windows
mostly share their minimiser, so they travel to its bucket together, as one packed string of words. Each task packs what
it has for a bucket into one compressed block. In a bucket, windows are sorted by content, then document, so that equal ones
meet, and every window that also starts in a smaller document is hit. Hits return to their documents by one join.

Skew: a passage that very many documents hold crosses the network once per task, because a task keeps only the smallest
document of each packed string and decides the others itself. Minimisers that still have more than a bucket's share
(counted over all documents in a first pass) give way to a hash of the whole window, so that their windows spread
over all buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import NOT_SPACE, Words, chunks, cover, find_words, fresh, hash_words, inside_one, mix, ranges, roll

FLUSH_BYTES = 24 << 20  # text that a task packs together
SEEN_OFTEN = 8  # packed strings of one minimiser in a flush before the first pass reports it
LEVEL = 6  # of block compression
LAST = np.iinfo(np.int64).max  # stands for a null doc_id


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for each i that has them all."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def _compact(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of a chunk, and its bytes with a single space between words; the words' positions point into those."""
    inside = NOT_SPACE[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    at = np.concatenate([[0], np.cumsum(keep)])
    w = find_words(np.where(inside, data, 0x20)[keep].astype(np.uint8), at[offsets])
    return w, w.data


class Runs:
    """Super-k-mers of a chunk: word position, windows, first byte, end byte, document, key and content hash."""

    def __init__(self, w: Words, window: int, piece: int, hot: np.ndarray):
        h = hash_words(w)
        valid = inside_one(w, window)
        whole = roll(h, window)
        key = sliding_min(roll(h, piece), window - piece + 1)
        alone = np.zeros(len(valid), bool)
        key = key[valid] if len(valid) else np.zeros(0, np.uint64)
        if len(hot) and len(key):
            at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
            alone = hot[at] == key
            key = np.where(alone, whole[valid], key)
        doc = w.doc[valid]
        new = np.ones(len(valid), bool)
        if len(valid):
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | alone[1:] | alone[:-1]
        head = np.flatnonzero(new)
        self.windows = np.diff(np.append(head, len(valid)))
        first = valid[head]
        last = first + self.windows + window - 2
        self.doc = doc[head]
        self.key = key[head]
        self.position = first - w.first[self.doc]
        self.begin, self.end = w.start[first], w.end[last]
        self.content = mix(whole[first] ^ (whole[last - window + 1] * np.uint64(3)) ^ self.windows.astype(np.uint64))


def _frequent(text: str, window: int, piece: int):
    """(key, n): windows for each minimiser that a task sees in several different packed strings."""

    def count(parts):
        key, content, n = (np.concatenate(x) for x in zip(*parts))
        _, one = np.unique(content, return_index=True)
        keys, code, times = np.unique(key[one], return_inverse=True, return_counts=True)
        windows = np.bincount(code, weights=n[one], minlength=len(keys)).astype(np.int64)
        often = times >= SEEN_OFTEN
        return pa.record_batch({"key": keys[often].view(np.int64), "n": windows[often], "total": np.zeros(often.sum(), np.int64)})

    def run(batches):
        none, parts, size, total = np.zeros(0, np.uint64), [], 0, 0
        for batch in batches:
            for _, data, offsets in chunks(batch, text):
                w, _ = _compact(data, offsets)
                r = Runs(w, window, piece, none)
                parts.append((r.key, r.content, r.windows))
                size, total = size + len(data), total + int(r.windows.sum())
                if size >= FLUSH_BYTES:
                    yield count(parts)
                    parts, size = [], 0
        if parts:
            yield count(parts)
        yield pa.record_batch({"key": pa.array([None], pa.int64()), "n": pa.array([0], pa.int64()), "total": pa.array([total], pa.int64())})

    return run


def _block(strings: list[bytes], doc, tag, position, windows) -> bytes:
    body = b"\n".join(strings)
    parts = [np.array([len(doc), len(body)], np.int64), np.diff(doc, prepend=np.int64(0)), tag, position, windows]
    raw = b"".join(p.tobytes() for p in parts) + body
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", compression_level=LEVEL).compress(raw, asbytes=True)


def _unblock(block: bytes):
    size = int(np.frombuffer(block, np.int64, 1)[0])
    raw = pa.decompress(block[8:], decompressed_size=size, codec="zstd", asbytes=True)
    n, body = (int(x) for x in np.frombuffer(raw, np.int64, 2))
    doc, tag = np.cumsum(np.frombuffer(raw, np.int64, n, 16)), np.frombuffer(raw, np.int64, n, 16 + 8 * n)
    position, windows = (np.frombuffer(raw, np.int32, n, 16 + 16 * n + 4 * n * i) for i in range(2))
    return doc, tag, position, windows, raw[len(raw) - body :]


def _pack(window: int, piece: int, buckets: int, hot):
    """Rows (bucket, decided, block) of (doc_id, tag, text): blocks of packed strings, and of runs that are hit for certain."""

    def flush(parts, strings):
        doc, tag, position, windows, key, content = (np.concatenate(x) for x in zip(*parts))
        bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((position, tag, doc, content, bucket))
        doc, tag, position, windows = doc[order], tag[order], position[order], windows[order]
        bucket, content = bucket[order], content[order]
        same = np.zeros(len(order), bool)
        same[1:] = content[1:] == content[:-1]
        for i in np.flatnonzero(same):  # equal hashes are compared, so none is taken for another
            same[i] = strings[order[i]] == strings[order[i - 1]]
        group = np.cumsum(~same) - 1
        least = doc[np.flatnonzero(~same)][group]
        decided = doc > least
        # Rows with one id and one text have the same runs: one of each is enough.
        once = ~same
        once[1:] |= (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (position[1:] != position[:-1])
        for told in (False, True):
            at = np.flatnonzero(once & (decided == told))
            if not len(at):
                continue
            # What is decided needs no company but that of its copies from other tasks, which are merged with it.
            own = mix(mix(doc[at].view(np.uint64)) ^ tag[at].view(np.uint64)) % np.uint64(buckets) if told else bucket[at]
            to = own.astype(np.int64)
            by = np.lexsort((position[at], doc[at], to))
            at, to = at[by], to[by]
            cuts = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
            blocks = [
                _block([] if told else [strings[i] for i in order[own]], doc[own], tag[own], position[own], windows[own])
                for own in np.split(at, cuts[1:-1])
            ]
            yield pa.record_batch(
                {
                    "bucket": to[cuts[:-1]].astype(np.int64),
                    "decided": pa.array([told] * len(blocks)),
                    "block": pa.array(blocks, pa.binary()),
                }
            )

    def run(batches):
        parts, strings, size = [], [], 0
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                w, flat = _compact(data, offsets)
                r = Runs(w, window, piece, hot.value)
                doc = np.asarray(part.column("doc_id")).astype(np.int64)[r.doc]
                tag = np.asarray(part.column("tag")).astype(np.int64)[r.doc]
                parts.append((doc, tag, r.position.astype(np.int32), r.windows.astype(np.int32), r.key, r.content))
                raw = flat.tobytes()
                strings += [raw[a:b] for a, b in zip(r.begin.tolist(), r.end.tolist())]
                size += len(data)
                if size >= FLUSH_BYTES:
                    if strings:
                        yield from flush(parts, strings)
                    parts, strings, size = [], [], 0
        if strings:
            yield from flush(parts, strings)

    return run


def _same_bytes(w: Words, a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Whether the windows at word positions a and b are the same text; words are one space apart."""
    la, lb = w.end[a + window - 1] - w.start[a], w.end[b + window - 1] - w.start[b]
    same = la == lb
    for some in np.array_split(np.flatnonzero(same), max(1, int(same.sum()) // 200_000 + 1)):
        if len(some):
            differs = w.data[ranges(w.start[a[some]], la[some])] != w.data[ranges(w.start[b[some]], la[some])]
            starts = np.cumsum(la[some]) - la[some]
            same[some] = ~np.logical_or.reduceat(differs, starts)
    return same


def _count(window: int):
    """A bucket's hits: (doc_id, tag, hits) with pairs of first window and number of windows, which do not overlap."""

    def run(table: pa.Table) -> pa.Table:
        told = [[], [], [], []]
        docs, tags, positions, counts, bodies = [], [], [], [], []
        for decided, block in zip(table.column("decided").to_pylist(), table.column("block").to_pylist()):
            doc, tag, position, n, body = _unblock(block)
            for into, x in zip(told if decided else (docs, tags, positions, counts), (doc, tag, position, n)):
                into.append(x)
            if not decided:
                bodies.append(body)
        if bodies:
            doc, tag, position = (np.concatenate(x) for x in (docs, tags, positions))
            data = np.frombuffer(b"\n".join(bodies), np.uint8)
            del bodies
            ends = np.flatnonzero(data == 0x0A)
            w = find_words(data, np.concatenate([[0], ends, [len(data)]]))
            at = inside_one(w, window)
            run_of = w.doc[at]
            h = roll(hash_words(w), window)[at]
            order = np.lexsort((doc[run_of], h))
            at, run_of, h = at[order], run_of[order], h[order]
            same = np.zeros(len(h), bool)
            same[1:] = h[1:] == h[:-1]
            twin = np.flatnonzero(same)
            truly = _same_bytes(w, at[twin], at[twin - 1], window)
            group = np.cumsum(~same) - 1
            own = doc[run_of]
            hit = own > own[np.flatnonzero(~same)][group]
            if not truly.all():  # different windows with one hash: settle those groups by their texts
                raw = w.data.tobytes()
                for g in np.unique(group[twin[~truly]]):
                    least: dict[bytes, int] = {}
                    for i in np.flatnonzero(group == g):
                        text = raw[w.start[at[i]] : w.end[at[i] + window - 1]]
                        hit[i] = own[i] > least.setdefault(text, int(own[i]))
            run_of, at = run_of[hit], at[hit]
            told[0].append(doc[run_of])
            told[1].append(tag[run_of])
            told[2].append((position[run_of] + at - w.first[run_of]).astype(np.int32))
            told[3].append(np.ones(len(at), np.int32))
        doc, tag, position, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in told)
        order = np.lexsort((position, tag, doc))
        doc, tag, position, n = doc[order], tag[order], position[order], n[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
        base = np.cumsum(new) << 32  # keeps the (doc_id, tag) apart
        reach = np.maximum.accumulate(base + position + n) if len(doc) else base
        joined = ~new
        joined[1:] &= (base + position)[1:] <= reach[:-1]
        head = np.flatnonzero(~joined)
        ends = (reach - base)[np.append(head[1:], len(doc))[: len(head)] - 1]
        spans = np.stack([position[head], ends - position[head]], 1).astype(np.int32).reshape(-1)
        cuts = np.flatnonzero(new[head])
        lengths = np.diff(np.append(cuts, len(head))) * 2
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.table(
            {
                "doc_id": pa.array(doc[head][cuts].astype(np.int64)),
                "tag": pa.array(tag[head][cuts].astype(np.int64)),
                "hits": pa.ListArray.from_arrays(pa.array(offsets), pa.array(spans)),
            }
        )

    return run


def _keep(text: str, window: int, hits_name: str, names: list[str]):
    def run(batches):
        for batch in batches:
            hits = batch.column(hits_name).to_pylist()
            row = 0
            for part, data, offsets in chunks(batch, text):
                w = find_words(data, offsets)
                total, own = w.count, hits[row : row + part.num_rows]
                row += part.num_rows
                drop = np.zeros(len(w.doc), bool)
                for i, lists in enumerate(own):
                    if lists:
                        pairs = np.concatenate([np.asarray(x, np.int64) for x in lists]).reshape(-1, 2)
                        drop[w.first[i] : w.first[i + 1]] = cover(pairs[:, 0], pairs[:, 1] + window - 1, int(total[i]))
                raw, kept = w.data.tobytes(), []
                for i in range(part.num_rows):
                    a, b = w.first[i], w.first[i + 1]
                    live = np.flatnonzero(~drop[a:b]) + a if own[i] else np.arange(a, b)
                    kept.append(b" ".join([raw[x:y] for x, y in zip(w.start[live].tolist(), w.end[live].tolist())]).decode("utf-8", "replace"))
                gone = np.add.reduceat(np.append(drop, False).astype(np.int64), np.minimum(w.first[:-1], len(drop)))
                gone[total == 0] = 0
                columns = {c: part.column(c) for c in part.schema.names if c != hits_name}
                yield pa.record_batch(columns | dict(zip(names, (total.astype(np.int64), gone, pa.array(kept, pa.string())))))

    return run


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window_words: int = 13,
    minimiser_words: int = 4,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """Each row of `docs` with n_words, n_removed and kept_text.

    A word (run of anything but ASCII white space, unchanged) is removed when a window of `window_words` words that
    covers it also starts in a row with a smaller doc_id. Windows are judged on the input. Hits return to rows by doc_id and a
    64-bit hash of the text, so two texts under one id (or without one) would have to agree in that to share theirs.

    Null and blank texts have no words and keep the empty text; texts shorter than a window keep everything, with single
    spaces. A null doc_id counts as larger than all others. Rows that repeat a doc_id never remove from each other.
    Extra columns pass through; the new names get a suffix where `docs` has them.
    """
    spark = docs.sparkSession
    names = fresh(docs, "n_words", "n_removed", "kept_text")
    key, tag, hits = fresh(docs, "_key", "_tag", "hits")
    keyed = docs.withColumn(key, F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST)))).withColumn(
        tag, F.xxhash64(text)
    )
    counted = docs.select(F.col(text).alias("text")).mapInArrow(
        _frequent("text", window_words, minimiser_words), "key long, n long, total long"
    )
    share = bucket_bytes // 20  # windows of a bucket: a packed one takes about three words
    sums = counted.groupBy("key").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where(f"key is null or n > {share}")
    found = sums.toArrow()  # one row for each `share` windows at most, and the total
    total = sum(found.column("total").to_pylist())
    hot = np.sort(np.array([k for k in found.column("key").to_pylist() if k is not None], np.int64).view(np.uint64))
    buckets = max(1, -(-total // share))
    blocks = keyed.select(F.col(key).alias("doc_id"), F.col(tag).alias("tag"), F.col(text).alias("text")).mapInArrow(
        _pack(window_words, minimiser_words, buckets, spark.sparkContext.broadcast(hot)),
        "bucket long, decided boolean, block binary",
    )
    found = (
        blocks.groupBy("bucket")
        .applyInArrow(_count(window_words), "doc_id long, tag long, hits array<int>")
        .groupBy("doc_id", "tag")
        .agg(F.collect_list("hits").alias("hits"))  # a window is in one list of its own bucket, and one of the decided
        .toDF("_d", "_t", hits)
    )
    joined = keyed.join(found, (F.col(key) == F.col("_d")) & (F.col(tag) == F.col("_t")), "left").drop("_d", "_t", key, tag)
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"{names[0]} long, {names[1]} long, {names[2]} string"])
    return joined.mapInArrow(_keep(text, window_words, hits, names), kind)
