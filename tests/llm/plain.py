"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text or "")) if w]


def simhash(text):
    w = words(text)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, tau=3):
    """Component roots of fingerprints by comparing all pairs."""
    own = sorted(set(prints))
    root = {f: f for f in own}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(own):
        for b in own[:i]:
            if bin(a ^ b).count("1") <= tau:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in own}


def line_dedup(docs, min_chars=40, min_docs=5):
    """docs: (doc_id, text) -> (lines, dropped, kept text) per row."""
    def key(line):
        return lower(line.strip(SPACE))

    held = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(d)
    rank = lambda d: (d is not None, d or 0)
    keeper = {k: max(v, key=rank) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == d]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def edited_sha(text, other):
    k = len(text) // 2
    return hashlib.sha256((text[:len(text) - k] + other[:k]).encode()).hexdigest()


def poisson_quantile(u, mean):
    k, p = 0, math.exp(-mean)
    total = p
    while total <= u and k < 1000:
        k += 1
        p *= mean / k
        total += p
    return k


def kneser_ney(trusted, order):
    """log probability function of the last symbol of an n-gram (tuple)."""
    counts = {order: Counter(trusted)}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off, sums = {}, {}
    for k, c in counts.items():
        n1, n2, n3, n4 = (sum(v == i for v in c.values()) for i in (1, 2, 3, 4))
        if n1 and n2 and n3:
            y = n1 / (n1 + 2 * n2)
            off[k] = [0, min(1, max(0, 1 - 2 * y * n2 / n1)), min(2, max(0, 2 - 3 * y * n3 / n2)),
                      min(3, max(0, 3 - 4 * y * n4 / n3))]
        else:
            off[k] = [0, 0.5, 0.75, 0.9]
        sums[k] = defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            sums[k][g[:-1]][0] += v
            sums[k][g[:-1]][1] += off[k][min(v, 3)]

    def p(g):
        if not g:
            return 1 / 4096
        k = len(g)
        below = p(g[1:])
        if g[:-1] not in sums[k]:
            return below
        total, taken = sums[k][g[:-1]]
        n = counts[k].get(g, 0)
        return (n - off[k][min(n, 3)] + taken * below) / total if n else taken * below / total

    return lambda g: math.log(p(g))


def fold(doc, modulus):
    return zlib.crc32(str(doc).encode()) % modulus if doc is not None else -1


def permutation_table(names, size):
    """Slot -> shard: whole preference lists, from which shards claim in turns."""
    import xxhash

    def lists(i):
        offset = xxhash.xxh64_intdigest(f"offset:{names[i]}".encode()) % size
        skip = xxhash.xxh64_intdigest(f"skip:{names[i]}".encode()) % (size - 1) + 1
        return [(offset + j * skip) % size for j in range(size)]

    wishes = {i: lists(i) for i in sorted(range(len(names)), key=lambda i: names[i])}
    owner = {}
    while len(owner) < size:
        for i, wish in wishes.items():
            if len(owner) < size:
                owner[next(slot for slot in wish if slot not in owner)] = i
    return [owner[slot] for slot in range(size)]
