"""Plain versions of the operators' contracts, without Spark."""

import hashlib
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def equal_texts(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normalised(t), []).append(i)
    return {(i, groups_min(g), len(g), groups_min(g) == i, hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}


def groups_min(ids):
    return min((i for i in ids if i is not None), default=None)


def without_repeats(rows, width=20):
    """{id: (words, removed, kept hash)} for rows with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = WORD.findall(t or "")
        gone = set()
        for s in range(len(words) - width + 1):
            w = tuple(words[s : s + width])
            if w in seen:
                gone.update(range(s, s + width))
            seen.add(w)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, n=5):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return set()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))}


def components(rows, percent=75):
    """[(id, shingles, component)] by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    members = {}
    for a in range(len(rows)):
        members.setdefault(find(a), []).append(rows[a][0])
    return sorted(((rows[a][0], len(sets[a]), groups_min(members[find(a)])) for a in range(len(rows))), key=str)


def nearest(ids, vectors, asked, k):
    out = []
    for q in asked:
        at = ids.index(q)
        scores = sorted(((-float(np.dot(v, vectors[at])), i) for i, v in zip(ids, vectors) if i != q))[:k]
        out += [(q, r + 1, i) for r, (s, i) in enumerate(scores)]
    return out
