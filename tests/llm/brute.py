"""Brute-force versions for small tables."""

import re


def shingles(text, width=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1)))


def components(rows, percent=85):
    """{(doc_id, text): smallest reachable doc_id} of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i] = parent[parent[i]]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j] and (
                    same or 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)):
                parent[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return [(d, len(sets[i]), None if d is None else low[top(i)]) for i, (d, _) in enumerate(rows)]
