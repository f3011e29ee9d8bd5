"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def without_repeats(docs, window=20):
    """{doc_id: (n_words, n_removed, sha256 of what is kept)} of (doc_id, text) rows."""
    first, out = {}, {}
    split = [(doc_id, words(text)) for doc_id, text in docs]
    for doc_id, own in split:
        for at in range(len(own) - window + 1):
            run = tuple(own[at:at + window])
            first[run] = min(first.get(run, (doc_id, at)), (doc_id, at))
    for doc_id, own in split:
        gone = set()
        for at in range(len(own) - window + 1):
            if first[tuple(own[at:at + window])] < (doc_id, at):
                gone.update(range(at, at + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out[doc_id] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n=5):
    own = words(ascii_lower(text))
    if not own:
        return set()
    size = min(n, len(own))
    return {tuple(own[i:i + size]) for i in range(len(own) - size + 1)}


def components(docs, percent=75):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {doc_id: shingles(text) for doc_id, text in docs}
    parent = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def top_k(vectors, queries, k=5):
    """[(query_id, rank, vec_id, score)] of {vec_id: integer list}."""
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=False)), i)
                        for i, v in vectors.items() if i != q)
        out += [(q, rank, i, -score) for rank, (score, i) in enumerate(scores[:k], 1)]
    return sorted(out)
