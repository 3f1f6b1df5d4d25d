"""Plain statements of the operators' results for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def remove_repeats(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest) for distinct doc_ids."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def smallest_reachable(nodes, links):
    up = {d: d for d in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {d: root(d) for d in nodes}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def jaccard_join(docs, threshold=90):
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {d: shingle_set(t) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    pairs = {(min(a, b), max(a, b)) for h in holders.values() for i, a in enumerate(h) for b in h[:i]}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    reach = smallest_reachable(sets, links)
    return {d: (len(s), reach[d]) for d, s in sets.items()}
