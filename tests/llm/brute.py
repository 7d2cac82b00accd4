"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups(vertices, links):
    """Smallest member of each vertex's component."""
    root = {v: v for v in vertices}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {v: find(v) for v in vertices}


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard_links(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    pairs = {p for h in holders.values() for p in combinations(sorted(h), 2)}
    return [
        (a, b)
        for a, b in pairs
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


ASSIGN = re.compile(
    "((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)


def secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(found)]
