"""Brute-force versions of the operators and small helpers."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_bytes(texts, width):
    """(removed, spans, kept) of each text: bytes under windows that start anywhere else too."""
    raw = [(t or "").encode() for t in texts]
    count = defaultdict(int)
    for b in raw:
        for k in range(len(b) - width + 1):
            count[b[k : k + width]] += 1
    out = []
    for b in raw:
        live = [True] * len(b)
        for k in range(len(b) - width + 1):
            if count[b[k : k + width]] > 1:
                live[k : k + width] = [False] * width
        spans = sum(1 for x in range(len(b)) if not live[x] and (x == 0 or live[x - 1]))
        out.append((len(b), live.count(False), spans, bytes(c for c, x in zip(b, live) if x)))
    return out


def later_words(docs, width):
    """id -> (words, removed, kept): words under windows that start earlier."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        w = WORD.findall(t or "")
        live = [True] * len(w)
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            if key in seen:
                live[k : k + width] = [False] * width
            seen.add(key)
        kept = [x for x, keep in zip(w, live) if keep]
        out[i] = (len(w), len(w) - len(kept), " ".join(kept))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_groups(docs):
    """id -> (set size, smallest id reachable)."""
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}
