"""SQL twins that are built from a rule."""

from __future__ import annotations

CRC32 = """xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda c: ascii(c))),
    lambda a, c: xor(a >> 8, crc_table[(xor(a, c) & 255) + 1])), 4294967295)"""


def _tree(first: str, name: str, levels: int) -> str:
    """CTEs over `first`(g, p, h, n): <name><k> the nodes of level k and <name>s<k> each node's siblings, if its level has several nodes."""
    out = []
    for k in range(levels):
        level = f"{name}{k}" if k else first
        out.append(
            f"{name}{k + 1} AS (SELECT g, p // 16 AS p, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h, "
            f"(any_value(n) + 15) // 16 AS n FROM {level} GROUP BY g, p // 16)"
        )
        out.append(
            f"{name}s{k} AS (SELECT a.g, a.p, any_value(a.n) AS n, coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (WHERE b.p < a.p), '') AS l, "
            f"coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (WHERE b.p > a.p), '') AS r "
            f"FROM {level} a JOIN {level} b ON a.g = b.g AND a.p // 16 = b.p // 16 GROUP BY a.g, a.p)"
        )
    return ",\n".join(out)


def _climb(rows: str, name: str, place: str, levels: int) -> tuple[str, str]:
    """CTEs that fold `rows`(g, pos, f, proof) up a tree level by level, and the last one's name."""
    out, now = [], rows
    for k in range(levels):
        key = f"x.{place} // {16**k}"
        group = "x.g" if place == "pos" else "0"
        out.append(
            f"{name}f{k} AS (SELECT x.* EXCLUDE (f, proof), CASE WHEN s.n = 1 THEN f ELSE sha256(s.l || f || s.r) END AS f, "
            f"CASE WHEN s.n = 1 THEN proof ELSE proof || s.l || s.r END AS proof "
            f"FROM {now} x JOIN {name}s{k} s ON s.g = {group} AND s.p = {key})"
        )
        now = f"{name}f{k}"
    return ",\n".join(out), now


def merkle(levels: int = 6, top_levels: int = 3) -> str:
    """Up to 16^levels rows of a source and 16^top_levels sources."""
    part = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR")
    plain = " || ".join(part.format(f) for f in (*fields, "text"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = " || ".join(part.format(f) for f in (*fields, lower))
    folds, last = _climb("start", "t", "pos", levels)
    top_folds, top_last = _climb(last, "u", "g", top_levels)
    crc = CRC32.format(text="doc_id::VARCHAR")
    return f"""
    WITH crc AS (
      SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc_table),
    leaves AS (
      SELECT doc_id, source, sha256({plain}) AS leaf,
             CASE WHEN doc_id IS NOT NULL AND ({crc}) % 5 = 0 THEN sha256({changed}) ELSE sha256({plain}) END AS other
      FROM documents, crc),
    trees AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source FROM documents)),
    placed AS (
      SELECT doc_id, leaf, other, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
      FROM leaves JOIN trees ON leaves.source IS NOT DISTINCT FROM trees.source),
    base AS (SELECT g, pos AS p, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed),
    {_tree("base", "t", levels)},
    subroots AS (SELECT 0 AS g, g AS p, h, count(*) OVER () AS n FROM t{levels}),
    {_tree("subroots", "u", top_levels)},
    start AS (SELECT doc_id, leaf, g, pos, other AS f, '' AS proof FROM placed),
    {folds},
    {top_folds}
    SELECT x.doc_id, x.leaf, s.h AS subroot, r.h AS root, sha256(x.proof) AS proof_sha256, x.f AS folded_root, x.f = r.h AS verified
    FROM {top_last} x JOIN subroots s ON s.p = x.g, u{top_levels} r
    """
