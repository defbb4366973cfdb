"""Plain Python statements of the contracts, for small inputs."""

import hashlib
import re

import numpy as np

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def contamination(docs, items):
    """docs, items: (id, text) lists -> one tuple per document."""
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                owners = windows.get(tuple(w[i:i + k]))
                if owners:
                    hit.update(range(i, i + k))
                    found |= owners
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        n_items = len({x for x in found if x is not None})
        out.append((doc, len(w), len(hit), n_items, hashlib.sha256(ids.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def shingles(text):
    w = SPACED.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def near_classes(docs):
    """docs: (id, text) list -> one (id, n_shingles, component, kept) per row."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            r = find(i)
            low[r] = min(low.get(r, doc), doc)
    out = []
    for i, (doc, _) in enumerate(docs):
        c = low.get(find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), c, doc == c))
    return out


def repeats(docs):
    """docs: (id, text) list in reading order -> (id, n_bytes, n_removed,
    n_spans, sha256 of kept, kept) per row, by id."""
    seen, out = set(), []
    for doc, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def best_products(rows, step=50, k=5):
    """rows: (vec_id, vector or None) list -> (query, rank, vec_id, score)."""
    good = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(good):
        if q is None or q % step:
            continue
        found = []
        for b, (i, y) in enumerate(good):
            n = min(len(x), len(y))
            if a != b:
                found.append((-int(x[:n] @ y[:n]), i is None, i or 0, i))
        out += [(q, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return out
