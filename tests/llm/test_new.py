"""Operators 11 to 13 against plain versions and SQL, with edge cases."""

import collections
import hashlib
import re
import zlib

import brute
import duckdb
import numpy as np
import pytest

from lakekit.llm import minhash
from lakekit.llm.divergence import divergence, gallop, merge_price, price, probabilities
from lakekit.llm.merkle import audit, build_manifest, missing_nodes, prove
from lakekit.llm.minhash import near_duplicates, sketches
from lakekit.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_source_divergence"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLES[name])
    assert tuples(got) == sorted((tuple(r) for r in want.select(*got.columns).fetchall()), key=str)


# 11


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows, width=16):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""

    def leaf(fields):
        return sha(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            now = levels[-1]
            levels.append([sha(*now[i : i + width]) for i in range(0, len(now), width)])
        return levels

    def siblings(levels, at):
        out = []
        for nodes in levels[:-1]:
            first = at // width * width
            out.append((nodes[first:at], nodes[at + 1 : first + width]))
            at //= width
        return out

    def fold(node, path):
        for before, after in path:
            node = sha(*before, node, *after)
        return node

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((r, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees.append(climb([x[1] for x in groups[name]]))
    top = climb([t[-1][0] for t in trees])
    out = []
    for g, name in enumerate(names):
        for at, (r, node) in enumerate(groups[name]):
            path = siblings(trees[g], at) + siblings(top, g)
            other = node
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                other = leaf((*r[:4], r[4] if r[4] is None else brute.lower(r[4])))
            folded = fold(other, path)
            proof = sha(*[n for before, after in path for n in (*before, *after)])
            out.append((r[0], node, trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
KIND = "doc_id long, source string, lang string, n_chars int, text string"


def check_manifest(spark, rows, parts=3):
    df = spark.createDataFrame(rows, KIND).repartition(parts).selectExpr("*", "'x' AS tree", "'x' AS place", "'x' AS leaf", "'x' AS N")
    assert tuples(audit(df).select(*COLUMNS)) == manifest(rows)


def test_manifest_edges(spark):
    rows = [
        (None, None, None, None, None),
        (5, "é", "de", 3, "Äb C"),
        (5, "é", "de", 3, "Äb C"),
        (5, "é", "de", 3, "other"),
        (7, "", "", 0, ""),
        (-3, "z", None, None, "X" * 300_000),
        (11, "\U0001f600", "en", 1, "A"),
        (12, "￮", "en", 1, "a"),
    ]
    check_manifest(spark, rows)


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257, 4097])
def test_manifest_sizes(spark, n):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(n)] + ([(10**6, "one", "en", 1, "B")] if n > 16 else [])
    check_manifest(spark, rows)


def test_manifest_many_groups(spark):
    check_manifest(spark, [(i, f"s{i % 40}", None, i, f"T{i}") for i in range(400)])


def test_manifest_of_nothing(spark):
    assert audit(spark.createDataFrame([], KIND)).count() == 0


def test_some_leaves_fetch_only_what_is_missing(spark):
    places = np.array([0, 1, 300])
    need = missing_nodes(places, 1000)
    # Level 0: the rest of two runs; level 1: runs 0 and 18 are derived; level 2: nodes 0 and 1 of four.
    assert [len(x) for x in need] == [14 + 15, 15 + 15, 2]
    rows = spark.createDataFrame([(i, "s", f"{i:064x}") for i in range(1000)], "doc_id long, source string, leaf string")
    m = build_manifest(rows)
    some = prove(m, m.leaves.where("doc_id in (0, 1, 300)").selectExpr("*", "cast(null AS string) AS other")).collect()
    every = {r.doc_id: r for r in prove(m, m.leaves.selectExpr("*", "cast(null AS string) AS other")).collect()}
    assert len(some) == 3 and all(r == every[r.doc_id] and r.verified for r in some)


# 12


def test_sketch_is_filled_and_estimates():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 1000, dtype=np.int64).astype(np.uint64)
    sets = [pool[:1], pool[:900], pool[100:], np.zeros(0, np.uint64)]
    at = np.cumsum([0] + [len(s) for s in sets])
    sketch = sketches(np.concatenate(sets), at)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (sketch[:3] != empty).all() and (sketch[3] == empty).all()
    assert abs((sketch[1] == sketch[2]).mean() - 0.8) < 0.15
    alone = sketches(pool[:900], np.array([0, 900]))
    assert (alone[0] == sketch[1]).all()


def near_rows(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(12):
        base = [f"w{x}" for x in rng.integers(0, 3000, 160)]
        for _ in range(8):
            own = list(base)
            for p in rng.integers(0, 160, rng.integers(0, 5)):
                own[p] = f"e{rng.integers(10**9)}"
            rows.append((len(rows), " ".join(own), "s"))
    return rows


def test_near_duplicates_equal_brute(frame):
    rows = near_rows()
    want = brute.jaccard([r[:2] for r in rows], 5, 85)
    assert 12 < len({c for _, c in want.values()}) < 90
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(rows)).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_near_duplicates_in_small_regions(frame):
    """Regions split further where they hold too many sets for a task."""
    rows = near_rows(4)
    want = brute.jaccard([r[:2] for r in rows], 5, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(rows), region_docs=4).collect()}
    assert got == want


def test_near_duplicates_odd_rows(frame, odd):
    got = near_duplicates(frame(odd)).collect()
    assert len(got) == len(odd)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert all(r.component_id is None and r.kept for r in by_id[None])
    assert [by_id[i][0].component_id for i in (3, 4, 5)] == [3, 4, 5]
    assert by_id[7][0].component_id == 6 and not by_id[7][0].kept
    assert len(by_id[11]) == 2 and all(r.kept for r in by_id[11])
    assert near_duplicates(frame([])).count() == 0


def test_bands_miss_no_threshold_pair():
    assert (1 - 0.85**minhash.BAND_ROWS) ** minhash.BANDS < 1e-9
    assert minhash.BANDS * minhash.BAND_ROWS == minhash.COORDINATES


# 13


def diverge(rows, min_docs=3, top=200):
    terms = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    split = [(lang or "", source or "", terms.findall(brute.lower(text))) for lang, source, text in rows]
    out = []
    for lang in {x[0] for x in split}:
        own = [x for x in split if x[0] == lang]
        held = collections.Counter(t for _, _, w in own for t in set(w))
        kept = {t for t, n in held.items() if n >= min_docs}
        counts = {s: collections.Counter(t for _, z, w in own if z == s for t in w if t in kept) for s in {x[1] for x in own}}
        whole = sum(counts.values(), collections.Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept))

        for s, c in counts.items():
            pair = [(o, sum((p(c, t) - p(d, t)) ** 2 // p(d, t) for t in kept)) for o, d in counts.items() if o != s]
            term = [(t, (p(c, t) - p(whole, t)) ** 2 // p(whole, t)) for t in c if p(c, t) > p(whole, t)]
            for part, found, limit in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found[:limit])]
    return sorted(out, key=str)


def language_rows():
    rng = np.random.default_rng(9)
    rows = [(lang, s, " ".join(f"t{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in rng.zipf(1.4, 60) % 300)) for lang in "xy" for s in "abc" for _ in range(9)]
    # Groups without terms or kept terms, nulls, ties, repeats, digits and other alphabets as parts of a text.
    rows += [("x", "none", None), ("x", None, ""), (None, None, "alone Alone"), (None, "q", "beside"), ("z", "m", "12 34 _ -")]
    rows += [("x", "é", "漢字 ß2ß É-é É")] * 3 + [("x", "long", "word " * 50_000)] * 3
    return rows


@pytest.mark.parametrize("block_bits", [18, 3])
def test_divergence_equals_brute(spark, block_bits):
    rows = language_rows()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    df = df.selectExpr("*", "'x' AS term", "1 AS n", "1 AS p", "'x' AS Item")
    got = divergence(df, top_terms=7, block_bits=block_bits).select("lang", "source", "part", "item", "value", "rank")
    assert tuples(got) == diverge(rows, top=7)


def test_divergence_of_nothing(spark):
    assert divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_gallop():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (3, 4000), (200, 300), (1, 1), (40, 65)):
        a, b = (np.unique(rng.integers(0, 6000, k)) for k in (n, m))
        want = [list(b).index(x) if x in b else -1 for x in a]
        assert gallop(a, b).tolist() == want


def test_prices_beyond_a_long():
    ids, n = np.arange(4), np.array([10**14, 0, 5, 1])
    none = np.zeros(0, np.int64)
    united, there, back = merge_price((ids, n, int(n.sum())), (none, none, 0), 4)
    p, q = probabilities(n, int(n.sum()), 4), probabilities(np.zeros(4, np.int64), 0, 4)
    assert united == 4 and there == sum(int(x) for x in price(p, q)) and back == sum(int(x) for x in price(q, p))
    assert p.tolist() == [1 + 10**9 * (int(c) + 1) // (int(n.sum()) + 4) for c in n]
