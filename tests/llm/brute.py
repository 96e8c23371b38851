"""Plain Python versions of the operators' definitions."""

import hashlib
import re
import string
from collections import Counter, defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER))


def contamination(text, items, window=13):
    """``n_words, n_hit, n_items, items_sha256, contaminated``; ``items`` are ``(item_id, text)``."""
    own = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        other = words(item)
        if item_id is None or not other:
            continue
        n = min(window, len(other))
        windows = {tuple(other[i : i + n]) for i in range(len(other) - n + 1)}
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)


def shingles(text, n=3):
    own = tokens(text)
    return frozenset(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))) if own else frozenset()


def near_components(docs, n=3, percent=90):
    """``(n_shingles, component)`` per row of ``(doc_id, text)``, by all pairs that share a shingle of ``n`` words."""
    sets = [shingles(text, n) for _, text in docs]
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for shingle in own:
            holders[shingle].append(i)
    shared = Counter((a, b) for at in holders.values() for k, b in enumerate(at) for a in at[:k])
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[top(a)] = top(b)
    smallest = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            smallest[top(i)] = min(smallest.get(top(i), doc_id), doc_id)
    return [(len(s), smallest.get(top(i)) if s else docs[i][0]) for i, s in enumerate(sets)]


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
