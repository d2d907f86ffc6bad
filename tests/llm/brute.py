"""Plain single-process versions of the operators, to compare with."""

import hashlib
from collections import defaultdict

BLANK = b" \t\n\x0b\x0c\r"


def raw(text):
    return b"" if text is None else text.encode()


def cut_repeats(docs, width=50):
    """``[(id, text)] -> {id: (words, removed, sha256 of what is kept)}``."""
    first = {}
    for i, text in docs:
        ws = raw(text).split()
        for at in range(len(ws) - width + 1):
            key = tuple(ws[at:at + width])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, text in docs:
        ws = raw(text).split()
        gone = [False] * len(ws)
        for at in range(len(ws) - width + 1):
            if first[tuple(ws[at:at + width])] < i:
                gone[at:at + width] = [True] * width
        kept = b" ".join(w for w, g in zip(ws, gone) if not g)
        out[i] = (len(ws), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def components(docs, k=4, percent=80):
    """``[(id, text)] -> {id: (set size, smallest id reachable)}`` by comparing every pair that shares a shingle."""
    sets = {}
    for i, text in docs:
        ws = raw(text).lower().split()
        grams = {tuple(ws[a:a + k]) for a in range(len(ws) - k + 1)}
        sets[i] = grams or ({tuple(ws)} if ws else set())
    inverted = defaultdict(list)
    for i, grams in sets.items():
        for g in grams:
            inverted[g].append(i)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i in sorted(sets):
        common = defaultdict(int)
        for g in sets[i]:
            for j in inverted[g]:
                if j > i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}
