"""Small pure-Python answers to compare with."""

import math
from collections import defaultdict

import numpy as np


def depths(ids, edges, root):
    """(depth, state) per id, by following every edge up to len(ids) times."""
    reached, grown = {root}, True
    while grown:
        more = {d for s, d in edges if s in reached} - reached
        grown = bool(more)
        reached |= more
    live = [(s, d) for s, d in edges if s in reached]
    best = {root: 0}
    for _ in range(len(ids) + 1):
        for s, d in live:
            if s in best:
                best[d] = max(best.get(d, 0), best[s] + 1)
    before = dict(best)
    unbounded = set()
    for _ in range(len(ids) + 1):
        for s, d in live:
            if s in unbounded or best[s] + 1 > best[d]:
                unbounded.add(d)
                best[d] = max(best[d], best[s] + 1)
    on_cycle = {v for group in components(ids, live) for v in group} | {s for s, d in live if s == d}
    out = {}
    for i in ids:
        if i not in reached:
            out[i] = (None, "unreachable")
        elif i in unbounded:
            out[i] = (None, "cyclic" if i in on_cycle else "below_cycle")
        else:
            out[i] = (before[i], "reached")
    return out


def closure(ids, edges):
    """Hops >= 1 from each id, as {id: {other: hops}}."""
    after = defaultdict(set)
    for s, d in edges:
        after[s].add(d)
    found = {}
    for i in ids:
        hops, front, n = {}, {i}, 0
        while front:
            n += 1
            front = {d for s in front for d in after[s]} - set(hops)
            hops.update(dict.fromkeys(front, n))
        found[i] = hops
    return found


def components(ids, edges):
    """Strongly connected components of two or more."""
    hops = closure(ids, edges)
    groups = {frozenset({i, *(j for j in hops[i] if i in hops[j])}) for i in ids}
    return [g for g in groups if len(g) > 1]


def arithmetic(text):
    """Recursive descent over float32, None where the text is malformed."""
    at = 0

    def blank():
        nonlocal at
        while at < len(text) and text[at] in " \t\n\r\f\v":
            at += 1

    def take(marks):
        nonlocal at
        blank()
        if at < len(text) and text[at] in marks:
            at += 1
            return text[at - 1]
        return None

    def number():
        nonlocal at
        blank()
        start, seen = at, at
        if at < len(text) and text[at] == "-":
            at += 1
        body = at
        while at < len(text) and (text[at].isdigit() or text[at] in ".e"):
            at += 1
            try:
                float(text[body:at])
                seen = at
            except ValueError:
                pass
        at = seen
        return np.float32(float(text[start:seen])) if seen > start else None

    def factor():
        if take("("):
            value = level(0)
            return value if value is not None and take(")") else None
        return number()

    def level(rank):
        left = level(1) if rank == 0 else factor()
        if left is None:
            return None
        sign = take("+-" if rank == 0 else "*/")
        if sign is None:
            return left
        right = level(rank)
        if right is None:
            return None
        with np.errstate(all="ignore"):
            return {"+": np.add, "-": np.subtract, "*": np.multiply, "/": np.divide}[sign](left, right)

    value = level(0)
    blank()
    return float(value) if value is not None and at == len(text) else None


def hierarchy(parents):
    """(level, path ids top first, iscyclic, isleaf) per id from {id: parent or None}."""
    out = {}
    kids = defaultdict(set)
    for child, parent in parents.items():
        if parent is not None and parent != child:
            kids[parent].add(child)
    for i in parents:
        walk, here = [], i
        while here is not None and here not in walk:
            walk.append(here)
            here = parents[here]
        cyclic = here is not None
        if cyclic:
            n = len(walk) - walk.index(here)
            size = n + walk.index(here)
            walk, here = [], i
            for _ in range(size):
                walk.append(here)
                here = parents[here]
        out[i] = (len(walk), walk[::-1], int(cyclic), int(not kids[i]))
    return out


def distances(edges, source):
    best = {source: 0.0}
    for _ in range(len(edges) + 1):
        for s, d, w in edges:
            if s in best:
                best[d] = min(best.get(d, math.inf), best[s] + w)
    return best
