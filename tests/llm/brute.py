"""Plain single-process versions of the operators, by their contracts."""

import collections
import hashlib
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def jaccard(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = SPACE.findall(lower(t))
        grams = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets[i] = grams
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        shared = collections.Counter(j for g in sets[i] for j in holders[g] if j < i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def contamination(rows, items, k=13):
    windows = collections.defaultdict(set)
    for item, t in items:
        w = ALNUM.findall(lower(t))
        for j in range(len(w) - k + 1):
            windows[tuple(w[j : j + k])].add(str(item))
        if 0 < len(w) < k:
            windows[tuple(w)].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w = ALNUM.findall(lower(t))
        hit, found = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (of := windows.get(tuple(w[j : j + n]))) is not None:
                    hit.update(range(j, j + n))
                    found |= of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def repeats(rows, k=13):
    first = {}
    split = [(i, SPACE.findall(t or "")) for i, t in rows]
    for i, w in split:
        for j in range(len(w) - k + 1):
            key = tuple(w[j : j + k])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in split:
        drop = set()
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < i:
                drop.update(range(j, j + k))
        kept = " ".join(x for j, x in enumerate(w) if j not in drop)
        out.append((i, len(w), len(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def secrets(text):
    text, found = text or "", []
    assign = r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
    for k, (kind, pattern, ok) in enumerate(
        (
            ("assign", assign, lambda m: len(m[2]) >= 8),
            ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
            ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
        )
    ):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}", kind) for m in re.finditer(pattern, text) if ok(m)]
    found.sort()
    return (
        *(sum(f[3] == kind for f in found) for kind in ("assign", "access", "hex")),
        hashlib.sha256(",".join(f[2] for f in found).encode()).hexdigest(),
    )


def quality(text, k=8):
    text = text or ""
    w = SPACE.findall(text)
    at = collections.defaultdict(list)
    for j in range(len(w) - k + 1):
        at[tuple(w[j : j + k])].append(j)
    again = {p for places in at.values() if len(places) > 1 for j in places for p in range(j, j + k)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(again),
        len(w) < 20 or 100 * len(again) > 30 * len(w),
    )
