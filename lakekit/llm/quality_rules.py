"""Quality rules with repetition measured on a word suffix array of each document.

Suffixes are ordered by prefix doubling, many documents at a time: ranks by one word, then by two, four and so on, where only suffixes
that still tie are sorted again. Ranks of all levels are kept, so the longest common prefix of neighbours in the array falls
out of comparing levels from the largest down. Neighbours with a common prefix of `repeat_words` or more are the maximal
repeated substrings; their spans are united. A document fails when they cover too large a part, or the longest is too long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakekit.llm.common import Words, chunks, cover, find_words, fresh, hash_words

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def suffix_levels(code: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of `code` and the ranks by the first 1, 2, 4, ... codes (equal rank: equal prefix), each with a -1 at the end.

    A suffix ends where `code` does; codes of different documents must differ, so that no prefix runs on into the next document.
    """
    n = len(code)
    order = np.argsort(code, kind="stable")
    new = np.ones(n, bool)
    new[1:] = code[order[1:]] != code[order[:-1]]
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank.copy()], 1
    single = new & np.append(new[1:], True)
    active = order[~single]
    while len(active):
        ahead = rank[np.minimum(active + step, n)]
        by = np.lexsort((ahead, rank[active]))
        a, ahead = active[by], ahead[by]
        own = rank[a]
        block = np.ones(len(a), bool)
        block[1:] = own[1:] != own[:-1]
        start = np.maximum.accumulate(np.where(block, np.arange(len(a)), 0))
        place = own + np.arange(len(a)) - start
        new = block.copy()
        new[1:] |= ahead[1:] != ahead[:-1]
        rank[a] = np.maximum.accumulate(np.where(new, place, 0))
        levels.append(rank.copy())
        active = a[~(new & np.append(new[1:], True))]
        step *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank[:n]] = np.arange(n)
    return suffixes, levels


def repeats(w: Words, least: int) -> np.ndarray:
    """For each word position, the longest word run from there that its document also has elsewhere; 0 below `least`."""
    n = len(w.doc)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    _, code = np.unique(hash_words(w), return_inverse=True)
    suffixes, levels = suffix_levels(w.doc.astype(np.int64) * (int(code.max()) + 1) + code)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    first = levels[min(len(levels) - 1, least.bit_length() - 1)]
    pairs = np.flatnonzero(first[a] == first[b])  # they share the largest power of two up to `least`
    a, b = a[pairs], b[pairs]
    common, x, y = np.zeros(len(a), np.int64), a.copy(), b.copy()
    for j in range(len(levels) - 1, -1, -1):
        same = levels[j][np.minimum(x, n)] == levels[j][np.minimum(y, n)]
        step = np.where(same, 1 << j, 0)
        common, x, y = common + step, x + step, y + step
    common[common < least] = 0
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def _duplicate_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of `values` between neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _apply(text: str, names: list[str], repeat_words: int, least_words: int, repeat_percent: int, covered: float, longest: int):
    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                w = find_words(data, offsets)
                n_words = w.count.astype(np.int64)
                points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
                chars = points[w.end] - points[w.start]
                word_chars = per_document(chars, w.first)
                symbols = per_document(_SYMBOL[data].astype(np.int64), offsets)
                raw = data.tobytes()
                lines = np.array([_duplicate_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.int64)
                length = repeats(w, repeat_words)
                at = np.flatnonzero(length)
                inside = cover(at, length[at], len(w.doc))
                n_repeat = per_document(inside.astype(np.int64), w.first)
                repeat_chars = per_document(np.where(inside, chars, 0), w.first)
                top = np.zeros(part.num_rows, np.int64)
                np.maximum.at(top, w.doc[at], length[at])
                failed = (n_words < least_words) | (100 * n_repeat > repeat_percent * n_words)
                kept = ~failed & (repeat_chars <= covered * word_chars) & (top <= longest)
                columns = {c: part.column(c) for c in part.schema.names}
                values = (n_words, word_chars, symbols, lines, n_repeat, repeat_chars, top, failed, kept)
                yield pa.record_batch(columns | {k: pa.array(v) for k, v in zip(names, values)})

    return run


def apply_quality_rules(
    docs: DataFrame,
    text: str = "text",
    repeat_words: int = 8,
    least_words: int = 20,
    repeat_percent: int = 30,
    max_covered: float = 0.3,
    max_longest: int = 200,
) -> DataFrame:
    """Each row of `docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_repeat_chars, longest_repeat,
    base_failed and kept.

    Words are runs of anything but ASCII white space. A repeat is a run of `repeat_words` words or more that the text holds at
    two places or more, which may overlap. base_failed: fewer than `least_words` words, or repeats over more than `repeat_percent` % of
    them. kept: not base_failed, repeats over at most `max_covered` of the words' characters, and none longer than `max_longest` words.

    Null and blank texts have zeros and fail. Rows are judged one by one, so repeated rows get equal verdicts. Extra columns
    pass through; the new names get a suffix where `docs` has them.
    """
    names = fresh(
        docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeat_chars", "longest_repeat", "base_failed", "kept"
    )
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields])
    kind += "".join(f", {c} {'boolean' if i > 6 else 'long'}" for i, c in enumerate(names))
    return docs.mapInArrow(_apply(text, names, repeat_words, least_words, repeat_percent, max_covered, max_longest), kind)
