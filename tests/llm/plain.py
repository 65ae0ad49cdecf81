"""Plain Python versions of operators, for comparison."""

import math
import re
from collections import Counter

import numpy as np
import regex
import xxhash

from cuelake.llm import quality as q

SPACE = r"[^\x20\x09-\x0D]+"


def check_bins(bins, ids, lengths):
    """Every id of every text stands in one bin, in order, and every bin has the smallest length that holds it."""
    width, parts = 2, {}
    for r in bins:
        flat = np.frombuffer(bytes(r.ids), dtype=f"<u{width}")
        assert len(flat) == r.n_tokens and r.bin_length == min(c for c in lengths if c >= r.n_tokens)
        for d, p, a, z in zip(r.doc_ids, r.pieces, r.starts, [*r.starts[1:], r.n_tokens]):
            assert (d, p) not in parts
            parts[d, p] = flat[a:z].tolist()
    assert {d for d, _ in parts} == set(ids)
    for d, want in ids.items():
        assert sum((parts[d, p] for p in range(sum(k == d for k, _ in parts))), []) == want


def partitions(items):
    items = list(items)
    if not items:
        yield []
        return
    for rest in partitions(items[1:]):
        yield [[items[0]], *rest]
        for k in range(len(rest)):
            yield [*rest[:k], [items[0], *rest[k]], *rest[k + 1 :]]


def base(t):
    w = re.findall(SPACE, t)
    lines = [x for x in t.split("\n") if re.search(SPACE, x)]
    win = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {k for i in range(len(w) - 7) if win[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed


def _hash(kind, *words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), h)
    return h % q.BUCKETS + kind * q.BUCKETS


def grams(t):
    """Buckets of shapes, words and word pairs."""
    s = re.findall(SPACE, regex.sub(r"[\p{L}\p{N}]+", "a", t))
    w = [x for x in regex.split(r"[^\p{L}\p{M}\p{N}]+", t.lower()) if x]
    return [_hash(0, a, b) for a, b in zip(s, [*s[1:], "</s>"])], [_hash(1, x) for x in w], [_hash(2, a, b) for a, b in zip(w, [*w[1:], "</s>"])]


def quality(docs, trusted):
    """Base columns and the ratio of every text."""
    raw, good = [Counter() for _ in range(3)], [Counter() for _ in range(3)]
    found = {i: grams(t) for i, t in docs.items()}
    for i, f in found.items():
        for k in range(3):
            raw[k].update(f[k])
            good[k].update(f[k] if i in trusted else ())
    n, m = [sum(x.values()) + q.BUCKETS for x in raw], [sum(x.values()) + q.BUCKETS for x in good]

    def weight(k, b):
        p = (raw[k][b] + 1) / n[k]
        return math.log((good[k][b] + (1 if k == 0 else q.BUCKETS * p)) / m[k]) - math.log(p)

    out = {}
    for i, (s, u, v) in found.items():
        shapes = sum(weight(0, b) for b in s) / len(s) if s else 0.0
        words = sum((weight(1, a) + weight(2, b)) / 2 for a, b in zip(u, v)) / len(u) if u else 0.0
        out[i] = base(docs[i]), shapes + words
    return out


def shingles(t):
    w = t.encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} - {()}


def near(docs):
    """Smallest id reachable by pairs of similarity 0.8 or more."""
    sets, low = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}
    find = lambda i: i if low[i] == i else find(low[i])
    ids, holders = sorted(sets), {}
    for i in ids:
        for g in sets[i] or {None}:
            holders.setdefault(g, []).append(i)
    for i in ids:
        for j in {j for g in sets[i] or {None} for j in holders[g] if j > i}:
            if len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                low[b] = a
    return {i: find(i) for i in ids}
