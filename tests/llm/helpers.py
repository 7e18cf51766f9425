"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
FOLDED = re.compile(rb"[0-9a-z\x80-\xff]+")


def spaced(text):
    return [x.decode() for x in SPACED.findall((text or "").encode())]


def folded(text):
    raw = (text or "").encode()
    return [x.decode() for x in FOLDED.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in raw))]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cut(docs, window):
    """[(id, text)] -> [(id, n_words, n_removed, kept words)]; no id counts as the largest."""
    least = {}
    key = lambda i: (i is None, i or 0)
    for i, text in docs:
        w = spaced(text)
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            least[run] = min(least.get(run, key(i)), key(i))
    out = []
    for i, text in docs:
        w = spaced(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < key(i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(text, width=5):
    w = folded(text)
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def classes(docs, threshold=0.8, width=5):
    """{id: smallest id of its class} by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in docs if i is not None}
    words = {i: tuple(folded(t)) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    pairs = {(a, b) for held in holders.values() for n, b in enumerate(held) for a in held[:n]}
    for a, b in sorted(pairs):
        shared = len(sets[a] & sets[b])
        if words[a] == words[b] or shared >= threshold * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def contamination(docs, items, window=13):
    """[(id, n_words, n_hit, sorted items, contaminated)]."""
    runs = defaultdict(set)
    for item, text in items:
        w = folded(text)
        if w:
            size = min(window, len(w))
            for k in range(len(w) - size + 1):
                runs[tuple(w[k : k + size])].add(item)
    sizes = {len(x) for x in runs}
    out = []
    for i, text in docs:
        w = folded(text)
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (run := tuple(w[k : k + size])) in runs:
                    hit.update(range(k, k + size))
                    found |= runs[run]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), names, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out
