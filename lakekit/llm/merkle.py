"""Merkle manifest of a dataset, with the proofs of many rows at a time (octopus multiproofs).

Rows are leaves. Each group (a source) has a tree of runs of 16 over its leaves in order, and the group's roots are the leaves of one more tree.
Nodes have coordinates (tree, level, place); tree -1 is the one over groups, and a tree with n leaves has ceil(n / 16^k) nodes at level k.

1. Places come from one range shuffle and counts by range (`common.ranked`), so that a group with a third of all rows is spread like
   any other.
2. Interior nodes are built three levels at a time: 4096 neighbours form a block, which is hashed up in one task and leaves one node.
3. To prove a set of leaves, each block of up to 4096 neighbours among them works out the coordinates that it cannot derive itself: the
   siblings, level by level, of what it has. All blocks' coordinates are fetched in one join. A block then derives the interiors that
   its leaves share once, and writes each leaf's own proof from them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import materialize, ranked

WIDTH_BITS = 4  # 16 nodes in a run
BLOCK_LEVELS = 3  # levels that a task derives of 16^3 neighbours
TOP = -1  # the tree over the groups' roots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def join_hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, a colon and the value; a null is a dash."""

    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in fields]).cast("binary"), 256)


def lower_ascii(value: Column) -> Column:
    return F.translate(value, _UPPER, _LOWER)


def level_size(n: int, level: int) -> int:
    """Nodes at a level of a tree with n leaves."""
    return -(-n >> WIDTH_BITS * level) if level else n


def height(n: int) -> int:
    h = 0
    while level_size(n, h) > 1:
        h += 1
    return h


def missing_nodes(places: np.ndarray, n: int) -> list[np.ndarray]:
    """For each level below the root: the places of the nodes that the leaves at sorted `places` need and cannot derive."""
    out, known = [], places
    for level in range(height(n)):
        parents = np.unique(known >> WIDTH_BITS)
        runs = ((parents << WIDTH_BITS)[:, None] + np.arange(1 << WIDTH_BITS)).ravel()
        runs = runs[runs < level_size(n, level)]
        out.append(np.setdiff1d(runs, known, assume_unique=True))
        known = parents
    return out


@dataclass
class Manifest:
    """`leaves` (the row's columns kept, tree, place, n, leaf), `nodes` (tree, level, place, hash: all but the
    leaves), `trees` (group, tree, n, subroot), the number of `groups` and the `root` (None without rows)."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    groups: int
    root: str | None


_NODE = "tree long, level int, place long, hash string, n long"


def _climb(base: int):
    """All nodes up to BLOCK_LEVELS above the sorted neighbours (tree, place, hash, n) of one block at level `base`."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        first, hashes = table.column("place")[0].as_py(), table.column("hash").to_pylist()
        levels, places, found = [], [], []
        for level in range(base + 1, min(height(n), base + BLOCK_LEVELS) + 1):
            first >>= WIDTH_BITS  # a block begins at a multiple of 16 at each of its levels
            hashes = [join_hash(hashes[i : i + 16]) for i in range(0, len(hashes), 16)]
            levels += [level] * len(hashes)
            places += range(first, first + len(hashes))
            found += hashes
        return pa.table(
            {
                "tree": pa.array([tree] * len(found), pa.int64()),
                "level": pa.array(levels, pa.int32()),
                "place": pa.array(places, pa.int64()),
                "hash": pa.array(found, pa.string()),
                "n": pa.array([n] * len(found), pa.int64()),
            }
        )

    return run


def build_nodes(leaves: DataFrame) -> DataFrame:
    """All interior nodes (tree, level, place, hash, n) over `leaves` (tree, place, hash, n): one round for every three levels."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    base, now, found = 0, leaves.select("tree", "place", "hash", "n"), None
    while height(most) > base:
        key = [F.col("tree").alias("_tree"), F.shiftright("place", WIDTH_BITS * BLOCK_LEVELS).alias("_block")]
        rounds = materialize(now.groupBy(*key).applyInArrow(_climb(base), _NODE), "nodes")
        found = rounds if found is None else found.unionByName(rounds)
        base += BLOCK_LEVELS
        now = rounds.where(F.col("level") == base).select("tree", "place", "hash", "n")
    return leaves.select("tree", F.lit(0).cast("int").alias("level"), "place", "hash", "n").where("false") if found is None else found


def build_manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf") -> Manifest:
    """The manifest of stored `rows` with a `leaf` hash; groups go by `group` (null first, by UTF-8 bytes), leaves in them by `order`.

    Null `order` values come first; rows with equal `order` go by their hash, so that the root does not depend on the order of files. Rows
    that are equal altogether are a leaf each. An empty table has no root. Other columns stay, unless they are called
    tree, place or n.
    """
    groups = rows.groupBy(group).agg(F.count("*").alias("n"))
    trees = materialize(ranked(materialize(groups, "groups"), [], [group], "tree", "groups-ranked"), "trees")
    n_groups = trees.count()
    if not n_groups:
        none = rows.select("*", *[F.lit(0).cast("long").alias(c) for c in ("place", "tree", "n")])
        nodes = none.select("tree", F.lit(0).alias("level"), "place", F.col(leaf).alias("hash"))
        return Manifest(none, nodes, trees.withColumn("subroot", F.lit("")), 0, None)
    placed = ranked(rows, [group], [order, leaf], "place", "leaves-sorted")
    known = trees.select(F.col(group).alias("_group"), "tree", "n")
    leaves = placed.join(known, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    leaves = materialize(leaves, "leaves")
    own = leaves.select("tree", "place", F.col(leaf).alias("hash"), "n")
    nodes = build_nodes(own)
    # A tree's root is its only node at its height; the root of a single leaf is that leaf.
    roots = own.where("n = 1").select("tree", "hash").unionByName(
        nodes.where(F.expr(f"n > 1 AND place = 0 AND {_height_sql('n')} = level")).select("tree", "hash")
    )
    trees = materialize(trees.join(roots.withColumnRenamed("hash", "subroot"), "tree"), "trees")
    top = trees.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("subroot").alias("hash"))
    top = top.withColumn("n", F.lit(n_groups).cast("long"))
    above = build_nodes(top)
    every = nodes.unionByName(above).select("tree", "level", "place", "hash")
    every = every.unionByName(top.select("tree", F.lit(0).cast("int").alias("level"), "place", "hash"))
    root = top if n_groups == 1 else above.where((F.col("level") == height(n_groups)) & (F.col("place") == 0))
    return Manifest(leaves, every, trees, n_groups, root.first()["hash"])


def _height_sql(n: str) -> str:
    """The height of a tree with n > 1 leaves: hexadecimal digits of n - 1."""
    return f"length(hex({n} - 1))"


def _wanted(groups: int):
    """The coordinates (block, of_tree, level, place) that a block's wanted leaves cannot derive."""

    def run(table: pa.Table) -> pa.Table:
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        places = np.unique(table.column("place").to_numpy())
        block = int(places[0]) >> WIDTH_BITS * BLOCK_LEVELS
        need = [(tree, i, p) for i, p in enumerate(missing_nodes(places, n))]
        need += [(TOP, i, p) for i, p in enumerate(missing_nodes(np.array([tree]), groups))]
        size = sum(len(p) for _, _, p in need)
        return pa.table(
            {
                "_tree": pa.array([tree] * size, pa.int64()),
                "_block": pa.array([block] * size, pa.int64()),
                "tree": pa.array(np.concatenate([np.full(len(p), t) for t, _, p in need] or [np.zeros(0)]).astype(np.int64)),
                "level": pa.array(np.concatenate([np.full(len(p), i) for _, i, p in need] or [np.zeros(0)]).astype(np.int32)),
                "place": pa.array(np.concatenate([p for _, _, p in need] or [np.zeros(0)]).astype(np.int64)),
            }
        )

    return run


class Path:
    """The nodes above some leaves of one tree: shared interiors, and siblings below the root."""

    def __init__(self, leaves: dict[int, str], n: int, fetched: list[dict[int, str]]):
        self.levels = []  # of each level below the root: the hash of each place that is known
        self.n, known = n, leaves
        for level in range(height(n)):
            self.levels.append({**known, **fetched[level]})
            known = {p: join_hash(self.run(level, p << WIDTH_BITS)) for p in {q >> WIDTH_BITS for q in known}}
        (self.root,) = known.values()

    def run(self, level: int, place: int) -> list[str]:
        first = place >> WIDTH_BITS << WIDTH_BITS
        return [self.levels[level][p] for p in range(first, min(first + 16, level_size(self.n, level)))]

    def siblings(self, level: int, place: int) -> tuple[str, str]:
        run, at = self.run(level, place), place & 15
        return "".join(run[:at]), "".join(run[at + 1 :])

    def fold(self, place: int, node: str) -> str:
        """The root that `node` at a leaf's place leads to with the other nodes as they are."""
        for level in range(len(self.levels)):
            before, after = self.siblings(level, place >> WIDTH_BITS * level)
            node = join_hash([before, node, after])
        return node

    def proofs(self, places: list[int], rest: str) -> list[str]:
        """The siblings of each leaf, level by level, then `rest`; what leaves share is joined once."""
        above = {0: rest}
        for level in reversed(range(len(self.levels))):
            here = {p >> WIDTH_BITS * level for p in places}
            above = {p: "".join(self.siblings(level, p)) + above[p >> WIDTH_BITS] for p in here}
        return [above[p] for p in places]


def _expand(groups: int, root: str):
    """Proofs of a block's leaves (place, n, leaf, other) from them and the nodes fetched for them."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.num_rows
        tree, n = left.column("tree")[0].as_py(), left.column("n")[0].as_py()
        places, leaves, others = (left.column(c).to_pylist() for c in ("place", "leaf", "other"))
        own, top = [{} for _ in range(height(n))], [{} for _ in range(height(groups))]
        for t, level, p, h in zip(*(right.column(c).to_pylist() for c in ("tree", "level", "place", "hash"))):
            (top if t == TOP else own)[level][p] = h
        inner = Path(dict(zip(places, leaves)), n, own)
        outer = Path({tree: inner.root}, groups, top)
        (rest,) = outer.proofs([tree], "")
        folded = [outer.root if o is None else outer.fold(tree, inner.fold(p, o)) for p, o in zip(places, others)]
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in inner.proofs(places, rest)]
        out = {c: left.column(c) for c in KEPT}
        out |= {"subroot": [inner.root] * rows, "root": [root] * rows, "proof_sha256": digests, "folded_root": folded}
        return pa.table(out | {"verified": [f == root for f in folded]})

    return run


KEPT = ["doc_id", "tree", "place", "leaf"]
PROOF = "doc_id long, tree long, place long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """The proof of each of the `wanted` leaves: rows of `manifest.leaves` (all or some of them) with doc_id, tree, place, n and leaf, and
    `other`, a leaf to verify in place of the stored one (null: the stored one).

    proof_sha256 is the hash of all siblings up to the root, folded_root what `other` leads to with them, verified whether that is the root.
    A block asks for each node once, however many of its leaves need it; nodes that all blocks need (those of the top tree) repeat in the
    join once for every 4096 leaves. Rows equal in tree and place count as one leaf.
    """
    if not manifest.groups:
        return wanted.sparkSession.createDataFrame([], PROOF)
    block = F.shiftright("place", WIDTH_BITS * BLOCK_LEVELS).alias("_block")
    keyed = wanted.select("doc_id", "tree", "place", "n", "leaf", "other", F.col("tree").alias("_tree"), block)
    schema = "_tree long, _block long, tree long, level int, place long"
    need = keyed.select("tree", "place", "n", "_tree", "_block").groupBy("_tree", "_block").applyInArrow(_wanted(manifest.groups), schema)
    stored = manifest.leaves.select("tree", F.lit(0).cast("int").alias("level"), "place", F.col("leaf").alias("hash"))
    fetched = need.join(manifest.nodes.unionByName(stored), ["tree", "level", "place"])
    fetched = fetched.select("_tree", "_block", "tree", "level", "place", "hash")
    both = keyed.groupBy("_tree", "_block").cogroup(fetched.groupBy("_tree", "_block"))
    return both.applyInArrow(_expand(manifest.groups, manifest.root), PROOF)


def audit(docs: DataFrame, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", group: str = "source", text: str = "text", every: int = 5) -> DataFrame:
    """The proof of every row of `docs`, where rows whose crc32(doc_id as text) `every` divides are verified after a tamper: A-Z of the
    text in lower case.

    Nulls in any field are dashes in the leaf; a null text stays null, so its tampered row verifies, as does any without capitals; a null doc_id
    is never tampered with. Empty texts count 0 bytes. Texts are hashed in the scan, whole, and never move: 64 digits of each row go on. Rows that repeat
    an id are told apart by their hash, rows that are equal altogether are proved one by one. Columns beside the fields are not read.
    """
    tampered = [lower_ascii(F.col(f"`{c}`")) if c == text else F.col(f"`{c}`") for c in fields]
    chosen = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % every == 0
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{group}`").alias("source"),
        leaf_hash([F.col(f"`{c}`") for c in fields]).alias("leaf"),
        F.when(chosen, leaf_hash(tampered)).alias("other"),
    )
    manifest = build_manifest(materialize(rows, "rows"))
    return prove(manifest, manifest.leaves)
