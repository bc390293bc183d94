"""Plain versions of the operators, for small fixtures."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def jaccard(rows, k=5, pct=75):
    """rows: (doc_id, text). Sorted (doc_id, n, component)."""
    sets = [shingles(t, k) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    links = set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > i}:
            same = len(s & sets[j])
            if 100 * same >= pct * (len(s) + len(sets[j]) - same):
                links.add((i, j))
    label = components(len(rows), links)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[label[i]] = min(low.get(label[i], d), d)
    return sorted((d, len(sets[i]), low[label[i]]) for i, (d, _) in enumerate(rows))
