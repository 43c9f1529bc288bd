"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits are cut into ``m`` partitions of correlated bits.
If two fingerprints differ in at most ``tau`` bits, then for any integer
thresholds that sum to ``tau - m + 1`` some partition differs by at most
its threshold (-1 rules a partition out). Each fingerprint gets its own
thresholds by dynamic programming over estimated candidate counts, probes
the values within them, and candidates are verified by their bit distance.
Only distinct fingerprints take part, so exact copies cost nothing here.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcast.llm.common import components, row_key, write_table

SHINGLE = 3
MAX_DISTANCE = 3
BITS = 64
BLOCK_BITS = 11
PROBE_COST = 1.0


def _fingerprint(text: bytes, words: int, table: np.ndarray, digest) -> int:
    w = text.lower().split()
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(words))))
    h = np.array([digest(s, 42) for s in shingles], dtype=np.uint64)
    columns = h.view(np.uint8).reshape(-1, 8)
    if len(h) > 64:  # bit counts from byte histograms
        ones = np.concatenate([np.bincount(columns[:, j], minlength=256) @ table for j in range(8)])
    else:
        ones = np.unpackbits(columns, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprint(text_col, words: int = SHINGLE):
    """64-bit SimHash of a text column as a signed long.

    A-Z are lower-cased; words are runs without [\\x20\\x09-\\x0D]; shingles of
    ``words`` words (repeats included; a shorter text is one shingle) are
    hashed by XXH64 with seed 42. A bit is set if over half of the hashes
    have it. Null texts and texts without words: zero."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        from xxhash import xxh64_intdigest

        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        return pd.Series([_fingerprint(t, words, table, xxh64_intdigest) if t else 0 for t in texts], dtype="int64")

    return of(text_col.cast("binary"))


def hex_digits(fp):
    """16 lower-case hex digits of the fingerprint read as unsigned."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------- pigeonhole index

def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _values(bits: np.ndarray, group: list[int]) -> np.ndarray:
    """Integer value of the bits of ``group``."""
    return bits[:, group].astype(np.int64) @ (np.int64(1) << np.arange(len(group), dtype=np.int64))


def group_bits(agree: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal width; each starts at the bit most
    correlated with the rest and takes the bits most correlated with it."""
    left, groups = list(range(BITS)), []
    for i in range(m):
        width = len(left) // (m - i)
        seed = max(left, key=lambda b: (agree[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            best = max(left, key=lambda b: (agree[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def ball(width: int, radius: int) -> int:
    return sum(comb(width, k) for k in range(radius + 1))


def choose_m(n: int, tau: int) -> int:
    """Number of partitions with the least probes plus expected candidates
    for ``n`` spread-out fingerprints. It shapes the work, not the result."""
    def cost(m):
        spread = tau - m + 1
        per = [spread // m + (i < spread % m) for i in range(m)] if spread >= 0 else [0] * m
        widths = [BITS // m + (i < BITS % m) for i in range(m)]
        return sum(ball(w, t) * (1 + n / 2 ** w) for w, t in zip(widths, per))

    return min(range(2, max(2, tau + 1) + 1), key=cost)


def masks(width: int, radius: int) -> np.ndarray:
    """All values with at most ``radius`` set bits, by distance."""
    out = [0]
    for k in range(1, radius + 1):
        out += [sum(1 << b for b in c) for c in combinations(range(width), k)]
    return np.array(out, dtype=np.int64)


class Plan:
    """Partitions and candidate estimates; small and of fixed size."""

    def __init__(self, groups, tau: int, n: int, histograms: dict):
        self.groups, self.tau, self.n = groups, tau, n
        self.blocks = [[g[i:i + BLOCK_BITS] for i in range(0, len(g), BLOCK_BITS)] for g in groups]
        self.near: list[list[np.ndarray]] = []
        for p, blocks in enumerate(self.blocks):
            self.near.append([self._distances(histograms[p, b], len(x)) for b, x in enumerate(blocks)])

    def _distances(self, hist: np.ndarray, width: int) -> np.ndarray:
        """Share of fingerprints at block distance 0..tau of each block value."""
        values, out = np.arange(1 << width), np.zeros((self.tau + 1, 1 << width))
        for k in range(min(self.tau, width) + 1):
            for c in combinations(range(width), k):
                out[k] += hist[values ^ sum(1 << b for b in c)]
        return out / max(1, hist.sum())

    def thresholds(self, bits: np.ndarray) -> np.ndarray:
        """Per-fingerprint thresholds ``[rows, m]`` of least estimated cost."""
        tau, rows, m = self.tau, len(bits), len(self.groups)
        costs = np.zeros((m, tau + 2, rows))  # column t + 1
        for p, blocks in enumerate(self.blocks):
            share = np.zeros((tau + 1, rows))
            share[0] = 1
            for block, near in zip(blocks, self.near[p]):
                at = near[:, _values(bits, block)]
                share = np.array([sum(share[j] * at[k - j] for j in range(k + 1)) for k in range(tau + 1)])
            found = np.cumsum(share, axis=0) * self.n
            probes = np.array([ball(len(self.groups[p]), t) for t in range(tau + 1)])
            costs[p, 1:] = found + PROBE_COST * probes[:, None]
        best = np.full((tau + 2, rows), np.inf)
        best[0] = 0
        picks = []
        for p in range(m):  # best[s]: least cost with s spent on the first p partitions
            options = np.full((tau + 2, tau + 2, rows), np.inf)
            for s in range(tau + 2):
                for t in range(s + 1):
                    options[s, t] = best[s - t] + costs[p, t]
            picks.append(options.argmin(axis=1))
            best = options.min(axis=1)
        out = np.empty((rows, m), dtype=np.int64)
        spent = np.full(rows, tau + 1)
        for p in range(m - 1, -1, -1):
            t = picks[p][spent, np.arange(rows)]
            out[:, p] = t - 1
            spent = spent - t
        return out


def _batches(of):
    """mapInArrow body: ``of(uint64 fingerprints)`` gives arrays per batch."""
    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for names, arrays in of(fps):
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)

    return run


def make_plan(fps: DataFrame, n: int, tau: int) -> Plan:
    """Bit statistics over all distinct fingerprints, reduced on the
    executors to 64 x 64 counts and one histogram per bit block."""
    def together(v):
        bits = _bits(v).astype(np.int64)
        both = bits.T @ bits
        i, j = np.nonzero(both)
        yield ["i", "j", "n"], [i.astype(np.int32), j.astype(np.int32), both[i, j]]

    both = np.zeros((BITS, BITS))
    for r in (fps.mapInArrow(_batches(together), "i int, j int, n bigint")
              .groupBy("i", "j").agg(F.sum("n").alias("n")).collect()):
        both[r["i"], r["j"]] = r["n"]
    p = np.diag(both) / max(1, n)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    agree = np.abs(both / max(1, n) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(agree, 0)
    groups = group_bits(agree, choose_m(n, tau))
    blocks = [(g, b, x) for g, group in enumerate(groups)
              for b, x in enumerate(group[i:i + BLOCK_BITS] for i in range(0, len(group), BLOCK_BITS))]

    def histogram(v):
        bits = _bits(v)
        for g, b, x in blocks:
            count = np.bincount(_values(bits, x), minlength=1 << len(x))
            at = np.flatnonzero(count)
            yield ["g", "b", "v", "n"], [np.full(len(at), g, np.int32), np.full(len(at), b, np.int32),
                                         at.astype(np.int32), count[at].astype(np.int64)]

    histograms = {(g, b): np.zeros(1 << len(x)) for g, b, x in blocks}
    for r in (fps.mapInArrow(_batches(histogram), "g int, b int, v int, n bigint")
              .groupBy("g", "b", "v").agg(F.sum("n").alias("n")).collect()):
        histograms[r["g"], r["b"]][r["v"]] = r["n"]
    return Plan(groups, tau, n, histograms)


def links(fps: DataFrame, tau: int = MAX_DISTANCE) -> DataFrame:
    """Pairs ``(u, v)``, v < u, of distinct fingerprints that differ in at
    most ``tau`` bits; complete. ``fps`` has one column of distinct longs
    and is read several times (a written table)."""
    plan = make_plan(fps, fps.count(), tau)
    widths = [len(g) for g in plan.groups]
    shifts = np.array([p << 58 for p in range(len(widths))], dtype=np.int64)

    def index(v):
        bits = _bits(v)
        for p, group in enumerate(plan.groups):
            yield ["key", "v"], [_values(bits, group) + shifts[p], v]

    def probe(v):
        for lo in range(0, len(v), 4096):
            part = v[lo:lo + 4096]
            bits = _bits(part)
            limits = plan.thresholds(bits)
            for p, group in enumerate(plan.groups):
                values = _values(bits, group)
                for t in range(tau + 1):
                    rows = np.flatnonzero(limits[:, p] == t)
                    near = masks(widths[p], t)
                    step = max(1, 500_000 // len(near))
                    for a in range(0, len(rows), step):
                        r = rows[a:a + step]
                        keys = (values[r][:, None] ^ near[None, :]) + shifts[p]
                        yield ["key", "u"], [keys.ravel(), np.repeat(part[r], len(near))]

    indexed = fps.mapInArrow(_batches(index), "key bigint, v bigint")
    probed = fps.mapInArrow(_batches(probe), "key bigint, u bigint")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= tau
    return probed.join(indexed, (probed["key"] == indexed["key"]) & (F.col("v") < F.col("u")) & close).select("u", "v")


def near_duplicates(docs: DataFrame, *, words: int = SHINGLE, tau: int = MAX_DISTANCE) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    Rows whose fingerprints differ in at most ``tau`` bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable over links.
    Null ids never name a component unless all its rows lack one. Empty
    and null texts share fingerprint zero and are linked. Repeated rows
    stay; an empty table gives no rows. Other columns are not read.
    """
    prints, named = _grouped(docs, words, tau)
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, words: int, tau: int) -> tuple[DataFrame, DataFrame]:
    """Written tables: ``(doc_id, row, fp)`` of every row, and of every
    distinct ``fp`` its component and the component's keeper (the least
    ``(id, row key)``, null ids last)."""
    prints = write_table(docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"),
                                     fingerprint(F.col("text"), words).alias("fp")), "simhash-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    distinct = write_table(prints.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    found = components(links(distinct.select("fp"), tau))
    rooted = write_table(distinct.join(found, distinct["fp"] == found["node"], "left")
                         .select("fp", "first", F.coalesce("component", "fp").alias("root")), "simhash-roots")
    least = write_table(rooted.groupBy("root").agg(F.min("first").alias("first")), "simhash-least")
    named = write_table(rooted.select("fp", "root").join(least, "root")
                        .select("fp", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("keeper")),
                        "simhash-named")
    return prints, named


def keep_one(docs: DataFrame, *, words: int = SHINGLE, tau: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of its
    smallest id (equal ids: the least row hash; null ids last). Of rows that
    repeat the same id and text one stays. Empty table: no rows."""
    # ids as text, null as none: one plain key, so that join and dedup share a shuffle
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    keepers = _grouped(docs, words, tau)[1].select(F.col("keeper").alias("row"), text("component_id").alias("id")).distinct()
    # the documents as one struct, so that no name of theirs can clash
    held = docs.select(F.struct("*").alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("row"), text("doc_id").alias("id"))
    return held.join(keepers, ["row", "id"], "left_semi").dropDuplicates(["row", "id"]).select("doc.*")
