"""Benchmark decontamination: a broadcast set of benchmark word windows, scanned over every document's words.

The set is held as sorted hashes beside a bitmap that dismisses nearly all windows at once; a hit is verified word by word.
It is broadcast only up to `block_windows` windows. A larger benchmark is cut by hash into blocks of about that size; documents
pass them one after another, with their hits so far in the shared scratch folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import ALNUM, chunks, cover, find_words, fresh, hash_words, inside_one, list_array, materialize, roll

_BITS = np.uint64(64 - 22)


def _windows(window: int):
    """(hash, words, phrase, item_id) of a benchmark's windows; an item with fewer words is one window."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                w = find_words(data, offsets, ALNUM, lower=True)
                h = hash_words(w)
                raw = w.data.tobytes()
                starts, sizes, hashes = [inside_one(w, window)], [], []
                hashes.append(roll(h, window)[starts[0]])
                sizes.append(np.full(len(starts[0]), window))
                for short in range(1, window):
                    few = w.first[:-1][w.count == short]
                    if len(few):
                        starts.append(few)
                        hashes.append(roll(h, short)[few])
                        sizes.append(np.full(len(few), short))
                start, size, found = np.concatenate(starts), np.concatenate(sizes), np.concatenate(hashes)
                phrases = [b" ".join(raw[a:b] for a, b in zip(w.start[i : i + n], w.end[i : i + n])) for i, n in zip(start, size)]
                yield pa.record_batch(
                    {
                        "hash": found.view(np.int64),
                        "words": size.astype(np.int64),
                        "phrase": pa.array(phrases, pa.binary()),
                        "item_id": part.column("item_id").take(pa.array(w.doc[start])),
                    }
                )

    return run


class Windows:
    """The windows of a benchmark block: phrase and items by hash."""

    def __init__(self, table: pa.Table):
        self.items: dict[int, dict[bytes, list[str]]] = {}
        for h, phrase, item in zip(*(table.column(c).to_pylist() for c in ("hash", "phrase", "item_id"))):
            self.items.setdefault(h & (2**64 - 1), {}).setdefault(phrase, []).append(item)
        self.sizes = sorted(set(table.column("words").to_pylist()))
        self.hashes = np.sort(np.array(list(self.items), np.uint64))
        self._seen = None

    def candidates(self, h: np.ndarray) -> np.ndarray:
        if self._seen is None:
            self._seen = np.zeros(1 << 22, bool)
            self._seen[self.hashes >> _BITS] = True
        maybe = np.flatnonzero(self._seen[h >> _BITS])
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        return maybe[self.hashes[at] == h[maybe]]

    def __getstate__(self):
        return {**self.__dict__, "_seen": None}


def _scan(text: str, index, names: list[str], prior: bool):
    """Adds the word count, the hit words and the items that occur; with `prior`, to those of earlier blocks."""
    n_words, hit_words, items = names

    def run(batches):
        known: Windows = index.value
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                w = find_words(data, offsets, ALNUM, lower=True)
                h = hash_words(w)
                raw = w.data.tobytes()
                starts, sizes, found = [], [], {}
                for size in known.sizes:
                    rolled = roll(h, size)
                    at = known.candidates(rolled) if len(known.hashes) else np.zeros(0, np.int64)
                    at = at[w.doc[at] == w.doc[at + size - 1]]
                    for i in at.tolist():
                        phrase = b" ".join(raw[a:b] for a, b in zip(w.start[i : i + size], w.end[i : i + size]))
                        if (of := known.items[int(rolled[i])].get(phrase)) is not None:
                            starts.append(i)
                            sizes.append(size)
                            found.setdefault(int(w.doc[i]), set()).update(of)
                hit = cover(np.array(starts, np.int64), np.array(sizes, np.int64), len(w.doc))
                own = [found.get(i, set()) for i in range(part.num_rows)]
                at = np.flatnonzero(hit)
                places, lengths = at - w.first[w.doc[at]], np.bincount(w.doc[at], minlength=part.num_rows)
                if prior:
                    own = [a | set(b or ()) for a, b in zip(own, part.column(items).to_pylist())]
                    cuts = np.split(places, np.cumsum(lengths)[:-1])
                    merged = [np.union1d(a, np.array(b or [], np.int64)) for a, b in zip(cuts, part.column(hit_words).to_pylist())]
                    lengths = np.array([len(m) for m in merged])
                    places = np.concatenate(merged)
                columns = {c: part.column(c) for c in part.schema.names if c not in names}
                columns |= {
                    n_words: w.count.astype(np.int64),
                    hit_words: list_array(places.astype(np.int32), lengths),
                    items: pa.array([sorted(x) for x in own], pa.list_(pa.string())),
                }
                yield pa.record_batch(columns)

    return run


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window_words: int = 13,
    block_windows: int = 1 << 20,
) -> DataFrame:
    """Each row of `docs` with n_words, hit_words (positions of the words inside an occurring window) and items (ids as text, sorted).

    Words are runs of ASCII letters (in lower case), digits and other code points. A window is `window_words` consecutive words of
    an item; an item with fewer words, but not none, is one window. Null and blank texts have no words. A null item_id is reported as
    the text "null". Repeated items report each id once. An empty benchmark hits nothing. Extra columns pass through; the
    new names get a suffix where `docs` has them.
    """
    spark = docs.sparkSession
    names = fresh(docs, "n_words", "hit_words", "items")
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields])
    kind += f", {names[0]} long, {names[1]} array<int>, {names[2]} array<string>"
    entries = (
        benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item_id"), F.col(item_text).alias("text"))
        .mapInArrow(_windows(window_words), "hash long, words long, phrase binary, item_id string")
        .distinct()
    )
    entries = materialize(entries, "windows")
    blocks = max(1, -(-entries.count() // block_windows))
    out = docs
    for block in range(blocks):
        table = entries.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == block).toArrow()
        out = out.mapInArrow(_scan(text, spark.sparkContext.broadcast(Windows(table)), names, block > 0), kind)
        if block + 1 < blocks:
            out = materialize(out, "scanned")
    return out


def is_contaminated(hit_words, n_words, percent: int = 5):
    """At least one hit word, and at least `percent` in a hundred."""
    return (hit_words > 0) & (hit_words * 100 >= n_words * percent)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that are not contaminated, with their own columns."""
    found = find_contamination(docs, benchmark, **options)
    n_words, hit_words, _ = found.columns[len(docs.columns) :]
    return found.where(~is_contaminated(F.size(hit_words), F.col(n_words))).select(*[F.col(f"`{c}`") for c in docs.columns])


def _cut(text: str, hit_name: str, names: list[str]):
    def run(batches):
        for batch in batches:
            hits = batch.column(hit_name).to_pylist()
            row = 0
            for part, data, offsets in chunks(batch, text):
                w = find_words(data, offsets, ALNUM)
                out = []
                texts = part.column(text).to_pylist()
                for i, original in enumerate(texts):
                    at = hits[row + i]
                    if not at:
                        out.append(original)
                        continue
                    at = np.array(at) + w.first[i]
                    edges = np.flatnonzero(np.diff(at, prepend=-2) != 1)
                    raw, pieces, done = w.data[offsets[i] : offsets[i + 1]].tobytes(), [], 0
                    for a, b in zip(edges, np.append(edges[1:], len(at))):
                        pieces.append(raw[done : w.start[at[a]] - offsets[i]])
                        done = w.end[at[b - 1]] - offsets[i]
                    out.append(b"".join([*pieces, raw[done:]]).decode("utf-8", "replace"))
                row += part.num_rows
                columns = {c: part.column(c) for c in names}
                columns[text] = pa.array(out, pa.string())
                yield pa.record_batch(columns)

    return run


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` with the hit words, and what lies between neighbouring ones, cut out of the text; other columns as they are."""
    found = find_contamination(docs, benchmark, text=text, **options)
    hit_words = found.columns[len(docs.columns) + 1]
    return found.mapInArrow(_cut(text, hit_words, docs.columns), docs.schema)
