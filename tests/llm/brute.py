"""Plain Python versions of the operators, for small inputs."""

import re

SPACES = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(SPACES, text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, size=5):
    w = words(lower(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}


def jaccard_components(rows, size=5, percent=80):
    """rows: (doc_id, text) -> sorted [(doc_id, n_shingles, component_id)]"""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    pairs = {(i, j) for m in by.values() for k, i in enumerate(m) for j in m[k + 1:]}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)
