"""The profile filter of the Jaccard join keeps every link in one group, at widths from the least to several times that."""

import random
from types import SimpleNamespace

import pyarrow as pa

from lakekit.llm import ngram_jaccard as nj


def test_links_stay_together_at_all_lengths():
    draw = random.Random(3)
    texts = []
    for size in [5, 40, 300, 1900, 2040, 2200, 4000, 4300, 9000]:
        for _ in range(3):
            words = [f"w{draw.randrange(10**6)}" for _ in range(size)]
            for extra in (0, size // 30, size // 8):
                texts.append(" ".join(words + [f"x{draw.randrange(10**6)}" for _ in range(extra)]))
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    order = SimpleNamespace(value=nj.AnyOrder())
    rows = pa.Table.from_batches(nj._features("doc_id", "text", 4, 85, order)([batch]))
    assert len({len(p) for p in rows.column("profile").to_pylist()}) >= 3
    known = dict(zip(rows.column("digest").to_pylist(), texts))
    region = pa.array([7] * rows.num_rows, pa.int64())
    table = rows.select(["digest", "n_shingles", "profile"]).append_column("region", region)
    one = nj._may_link(85)(table)
    # The same documents by another pivot, in another order, form groups of the same names.
    again = nj._may_link(85)(table.take(list(range(rows.num_rows))[::-1]))
    pairs = lambda t: sorted(zip(t.column("region").to_pylist(), t.column("digest").to_pylist()))
    assert pairs(one) == pairs(again)
    group = dict((d, r) for r, d in pairs(one))
    sets = {}
    for digest, text in known.items():
        words = text.split()
        sets[digest] = {tuple(words[i : i + 4]) for i in range(len(words) - 3)}
    linked = 0
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                linked += 1
                assert group[a] == group[b]
    assert linked >= 20
    # Unrelated documents of every length are told apart.
    assert len(set(group.values())) >= 20
