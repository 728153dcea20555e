"""Plain Python versions of the operators' rules, for small inputs."""

import collections
import hashlib

SPACE = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    out, cur = [], ""
    for ch in (text or "") + " ":
        if ch in SPACE:
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += ch
    return out


def shingles(text, k=5):
    w = [x.translate(LOWER) for x in words(text)]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard_links(rows, threshold=0.8):
    """{row index: (class id, links)} for rows of (doc_id, text)."""
    sets = [shingles(t) if d is not None else frozenset() for d, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = collections.Counter()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return {i: (min((rows[k][0] for k in g), key=lambda x: (x is None, x)), links[i])
            for g in groups.values() for i in g}


def line_key(line):
    return line.strip(SPACE).translate(LOWER)


def dedup_lines(rows, least=40, docs=5):
    """[(doc_id, kept text, lines, dropped)] for rows of (doc_id, text)."""
    held = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= least:
                held[line_key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            ids = held.get(line_key(line), set())
            known = [x for x in ids if x is not None]
            if len(ids) < docs or not known or d == max(known):
                kept.append(line)
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def targets(sizes, cap=3.0):
    """{source: target} from {source: words}."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > cap * sizes[s]}
        if not above:
            return {**{s: cap * sizes[s] for s in full}, **share}
        full |= above


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
