"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_duplicates(docs):
    """doc_id -> (size, component) from all pairs."""
    sets = {d: shingles(t) for d, t in docs if d is not None}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def line_dedup(docs, min_chars=20, min_docs=3):
    """[(doc_id, lines, dropped, kept text)] for rows of different ids."""
    key = lambda line: line.strip(SPACES).translate(LOWER)
    holders = {}
    for d, t in docs:
        if d is not None:
            for line in (t or "").split("\n"):
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        stays = [
            x for x in lines
            if d is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == d
        ]
        out.append((d, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return out


def base_counts(text):
    w = words(text)
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, repeated, len(covered)


def quality_scores(docs, trusted, features, prior):
    """doc_id -> mean log ratio, with Spark's xxhash64 (seed 42, chained over the columns)."""
    import xxhash

    def number(*parts):
        seed = 42
        for part in parts:
            seed = xxhash.xxh64_intdigest(part.encode(), seed=seed)
        signed = seed - (1 << 64) if seed >> 63 else seed
        return signed % features

    found = {d: [number(a) for a in words(t)] + [number(a, b) for a, b in zip(words(t), words(t)[1:])] for d, t in docs}
    raw, good = Counter(), Counter()
    for d, f in found.items():
        raw.update(f)
        if d in trusted:
            good.update(f)
    all_raw, all_good = sum(raw.values()), sum(good.values())
    weight = lambda f: math.log((good[f] + prior) / (all_good + prior * features)) - math.log(
        (max(raw[f] - 1, 0) + prior) / (all_raw + prior * features)
    )
    return {d: sum(map(weight, f)) / len(f) if f and all_good else 0.0 for d, f in found.items()}


def targets(sizes, weights=(3, 1, 2), share=1.5):
    """source -> target by giving again what is over, as often as it takes."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = share * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        unit = sum(w[s] for s in order if s not in full)
        out = {s: 2.0 * sizes[s] if s in full else rest * w[s] / unit for s in order}
        over = {s for s in order if s not in full and out[s] >= 2 * sizes[s]}
        if not over:
            return out
        full |= over
        if len(full) == len(order):
            return {s: 2.0 * sizes[s] for s in order}


def base_score(tokens, counts):
    n, v = sum(counts.values()), len(counts)
    return sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
