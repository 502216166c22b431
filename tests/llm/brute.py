"""Plain Python forms of the operators, for small tables."""

import re

import numpy as np

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def groups(nodes, linked):
    """Least member per node over the transitive closure of ``linked``."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def removed_lines(docs, least_words):
    """docs: list of (id, text), ids distinct. Positions (id, i) in a later copy of a long enough run."""
    lines = [(d, i, line) for d, t in sorted(docs) for i, line in enumerate(t.split("\n"))]
    at = {(d, i): line for d, i, line in lines}
    gone = set()
    order = [(d, i) for d, i, _ in lines]
    for later, p in enumerate(order):
        best = 0
        for q in order[:later]:
            n = 0
            while (p[0], p[1] + n) in at and at[p[0], p[1] + n] == at.get((q[0], q[1] + n)):
                n += 1
            best = max(best, n)
        words = sum(len([w for w in re.split(f"[{BLANKS}]+", at[p[0], p[1] + k]) if w]) for k in range(best))
        if words >= least_words:
            gone |= {(p[0], p[1] + k) for k in range(best)}
    return gone


def fingerprint(text, shingle=4):
    import xxhash

    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(f"[^{BLANKS}]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def most_equal(document, item, window=13):
    """Most equal words in a window of any alignment."""
    best = 0
    for shift in range(-len(item), len(document) + 1):
        same = [0 <= q + shift < len(document) and document[q + shift] == item[q] for q in range(len(item))]
        best = max([best, *(sum(same[s : s + window]) for s in range(len(item)))])
    return best


def cosine_links(vectors, threshold=0.98):
    """vectors: {id: (vector, label)}. Links per id, and the least reachable id."""

    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        (x, k), (y, m) = vectors[a], vectors[b]
        if k is None or k != m or not fine(x) or not fine(y) or len(x) != len(y):
            return False
        x, y = np.array(x, float), np.array(y, float)
        return x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold

    counts = {a: sum(linked(a, b) for b in vectors if b != a) for a in vectors}
    return counts, groups(list(vectors), linked)


def trie(rows, rebuilt):
    """rows: (conv_id, turn, role, text). All nodes of the prefix trie, as tuples."""
    import hashlib
    import zlib

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], tie(t[2], t[3])))] for c, ts in convs.items()}
    if rebuilt:
        first = lambda c: c - int(np.fmod(c, 100))
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in convs}
        convs = {c: convs.get(first(c), [])[: h[c]] + ts[h[c] :] for c, ts in convs.items()}
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:-1] == p for q in nodes if q)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def tie(role, text):
    """Spark's 64-bit digests, by which turns with equal numbers are ordered."""
    import xxhash

    def chained(seed, *parts):
        state = xxhash.xxh64_intdigest(np.int32(seed).tobytes(), 42)
        for p in parts:
            state = xxhash.xxh64_intdigest(p.encode(), state)
        return state - (1 << 64) if state >> 63 else state

    return chained(1, role, text), chained(2, text, role)


def runs(words):
    """(start, length, period) of all runs of one document, by start, then period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def repeated_words(docs, window=13):
    """docs: list of (id, text). Per row (id, words, removed word numbers)."""
    split = [(d, re.findall(f"[^{BLANKS}]+", t or "")) for d, t in docs]
    least = {}
    for d, ws in split:
        for i in range(len(ws) - window + 1 if d is not None else 0):
            key = tuple(ws[i : i + window])
            least[key] = min(d, least.get(key, d))
    return [(d, ws, {i + j for i in range(len(ws) - window + 1 if d is not None else 0)
                     if least[tuple(ws[i : i + window])] < d for j in range(window)}) for d, ws in split]
