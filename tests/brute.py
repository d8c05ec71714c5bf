"""Plain Python references the distributed operators are checked against."""

from __future__ import annotations

import numpy as np


def phash_score(a, b):
    if not a or not b or len(a) != len(b):
        return None
    return sum(bin((x ^ y) & ((1 << 64) - 1)).count("1") for x, y in zip(a, b)) / len(a)


def cos_score(a, b):
    if not a or not b or len(a) != len(b):
        return None
    s = []
    for x, y in zip(a, b):
        x, y = np.asarray(x, float), np.asarray(y, float)
        d = np.linalg.norm(x) * np.linalg.norm(y)
        s.append(float(x @ y / d) if d > 0 else 0.0)
    return float(np.mean(s))


def sequential_greedy(items, score, is_match, better):
    """items: list of (id, sig) in visiting order. Returns {id: (primary, score, unique)}."""
    leaders, out = [], {}
    for vid, sig in items:
        if sig is None:
            out[vid] = (vid, None, True)
            continue
        best = None
        for lid, lsig in leaders:
            s = score(sig, lsig)
            if s is None or not is_match(s):
                continue
            if best is None or better(s, best[1]):
                best = (lid, s)
        if best is None:
            leaders.append((vid, sig))
            out[vid] = (vid, None, True)
        else:
            out[vid] = (best[0], best[1], False)
    return out


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}
