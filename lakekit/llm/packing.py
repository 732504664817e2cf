"""Token ids in packed binary matrices: best-fit-decreasing packing with a segment tree over free capacities.

Documents are encoded with a given vocabulary, ended by one end id, and cut losslessly into pieces of at most `length` ids. Each task
packs what it reads, `group_ids` ids at a time, so nothing moves between tasks and a lost executor repeats its own input only. A
packed row holds whole pieces; the best fit for a piece is the fullest row that still has room, found in a segment tree over the
capacities 0 to `length`.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Fixed value: how the byte-level BPE vocabularies of this kind split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY_BYTES = 64 << 20  # the largest vocabulary file that is broadcast
CACHED_WORDS = 400_000  # encoded words a task remembers
_UNEVEN = re.compile(r"\s | \s|^ | $")


class _Known(dict):
    """Encoded bytes by word; `lead` stands before each."""

    def __init__(self, encode, lead: str, kind: str):
        super().__init__()
        self.encode, self.lead, self.kind = encode, lead, kind

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self[word] = np.array(self.encode(self.lead + word), self.kind).tobytes()
        return ids


class Encoder:
    """Ids of a text, as little-endian bytes. A space between two words always begins a new piece of the pattern, so that
    words can be encoded, and remembered, one by one; a text with other runs of spaces is encoded as a whole."""

    def __init__(self, vocabulary: bytes, pattern: str, kind: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.model = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.kind = kind
        self.first = _Known(self.model.encode_ordinary, "", kind)
        self.rest = _Known(self.model.encode_ordinary, " ", kind)

    def __call__(self, text: str) -> np.ndarray:
        if _UNEVEN.search(text):
            return np.array(self.model.encode_ordinary(text), self.kind)
        words = text.split(" ")
        return np.frombuffer(self.first[words[0]] + b"".join(map(self.rest.__getitem__, words[1:])), self.kind)


class Capacities:
    """Rows by free capacity, in a segment tree that answers the smallest capacity of at least a given size."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        at = capacity + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, row) of the best fit, removed; None if nothing fits."""
        at = size + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        while at:
            self.count[at] -= 1
            at >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers whose sizes (1 to `length`) add up to `length` at most."""
    free, rows = Capacities(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if (found := free.take(sizes[i])) is None:
            rows.append([i])
            left = length - sizes[i]
            row = len(rows) - 1
        else:
            left, row = found[0] - sizes[i], found[1]
            rows[row].append(i)
        if left:
            free.add(left, row)
    return rows


def _pack(doc_id, text, encoder, length: int, end_id: int, pad_id: int, kind: str, group_ids: int, matrix_rows: int):
    def matrices(pieces):
        rows = best_fit_decreasing([len(p[2]) for p in pieces], length)
        for at in range(0, len(rows), matrix_rows):
            own = rows[at : at + matrix_rows]
            ids = np.full((len(own), length), pad_id, kind)
            positions = np.zeros((len(own), length), "<i4")
            ends, docs, parts = [], [], []
            for r, members in enumerate(own):
                done, cuts = 0, [0]
                for i in members:
                    size = len(pieces[i][2])
                    ids[r, done : done + size] = pieces[i][2]
                    positions[r, done : done + size] = np.arange(size)
                    done += size
                    cuts.append(done)
                ends.append(cuts)
                docs.append([pieces[i][0] for i in members])
                parts.append([pieces[i][1] for i in members])
            yield pa.record_batch(
                {
                    "rows": pa.array([len(own)], pa.int32()),
                    "ids": pa.array([ids.tobytes()], pa.binary()),
                    "positions": pa.array([positions.tobytes()], pa.binary()),
                    "cu_seqlens": pa.array([ends], pa.list_(pa.list_(pa.int32()))),
                    "doc_ids": pa.array([docs], pa.list_(pa.list_(pa.int64()))),
                    "parts": pa.array([parts], pa.list_(pa.list_(pa.int32()))),
                }
            )

    def run(batches):
        encode = Encoder(*encoder.value)
        pieces, held = [], 0
        for batch in batches:
            for doc, value in zip(batch.column(doc_id), batch.column(text)):
                doc, value = doc.as_py(), value.as_py()
                ids = np.append(encode(value) if value else np.zeros(0, kind), np.array(end_id, kind)).astype(kind)
                for part, at in enumerate(range(0, len(ids), length)):
                    pieces.append((doc, part, ids[at : at + length]))
                held += len(ids)
                if held >= group_ids:
                    yield from matrices(pieces)
                    pieces, held = [], 0
        if pieces:
            yield from matrices(pieces)

    return run


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 2048,
    end_id: int = 50256,
    pad_id: int = 50256,
    pattern: str = PATTERN,
    kind: str = "<u2",
    group_ids: int = 4 << 20,
    matrix_rows: int = 256,
) -> DataFrame:
    """Packed matrices: rows, ids and positions (`rows` x `length` little-endian numbers, row by row: `kind` and int32), and for each row
    cu_seqlens (0 and the end of each segment), doc_ids and parts (place of the piece in its document).

    `vocabulary` is the path of a rank file (base64 token and rank, one a line), read by the driver. Every document ends with `end_id`; null and
    empty texts are that id alone. Positions begin at 0 in each segment and are 0 in the padding. A long document is several
    pieces, in order of `parts`, that joined give all its ids. Null and repeated ids are carried as they are; other columns
    are not read. No documents give no matrices.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is too large to broadcast")
    encoder = spark.sparkContext.broadcast((data, pattern, kind))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        _pack("doc_id", "text", encoder, length, end_id, pad_id, kind, group_ids, matrix_rows),
        "rows int, ids binary, positions binary, cu_seqlens array<array<int>>, doc_ids array<array<bigint>>, parts array<array<int>>",
    )


def sequences(matrices: DataFrame, length: int = 2048, id_bytes: int = 2) -> DataFrame:
    """One row for each packed sequence of stored matrices: ids, positions, cu_seqlens, doc_ids and parts."""
    row = F.posexplode(F.arrays_zip("cu_seqlens", "doc_ids", "parts")).alias("_row", "_of")
    cut = matrices.select("ids", "positions", row)
    return cut.select(
        F.expr(f"substring(ids, _row * {length * id_bytes} + 1, {length * id_bytes})").alias("ids"),
        F.expr(f"substring(positions, _row * {length * 4} + 1, {length * 4})").alias("positions"),
        "_of.cu_seqlens",
        "_of.doc_ids",
        "_of.parts",
    )
