"""Plain re-computations that the operators are held against."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def groups(n: int, links) -> list[int]:
    """Smallest position reachable, by union-find over positions."""
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for i, j in links:
        i, j = find(i), find(j)
        up[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def near_duplicates(rows: list[tuple], percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) for (doc_id, text), ids distinct and not null."""
    rows = sorted(rows, key=lambda r: r[0])
    sets = [shingles(t) for _, t in rows]
    posting: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            posting.setdefault(x, []).append(i)
    common: dict = {}
    for at in posting.values():
        for k, i in enumerate(at):
            for j in at[:k]:
                common[j, i] = common.get((j, i), 0) + 1
    links = [(j, i) for (j, i), c in common.items() if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c)]
    root = groups(len(rows), links)
    return [(d, len(s), rows[root[i]][0], root[i] == i) for i, ((d, _), s) in enumerate(zip(rows, sets))]
