"""Document fingerprints by a randomised edit embedding.

A text is read by a random walk shared by all documents: at step j the
walk writes the current character and moves on to the next one if a random
bit of (j, character) is set, until the text ends; the number of steps, about
twice the text's length, is the length of the written string. Texts at
small edit distance are written alike, so edit distance becomes Hamming
distance between the written strings. A fingerprint samples ``WIDTH`` places
of the written string: of each bin of places the one with the least random
rank below the string's length, so strings of similar length sample the same
places. Each place
keeps 4 hashed bits. Two fingerprints are compared by banding (some group
of sampled places must agree) and then verified over all places.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 256
BAND = 4
NONE = 16  # no place of the bin lies within the text
PAD = np.uint32(0xFFFFFFFF)
BLOCK = 64
FEW_LANES = 16
MIX = 0x9E3779B1
BATCH_CHARS = 8_000_000
PARTITION_BYTES = 24 << 20
MAX_PARTITIONS = 20_000


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """64-bit finalizer of place numbers."""
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Places:
    """Sampled places: per bin, the places whose rank is below all earlier
    ranks of the bin. Grown on demand to the longest string seen."""

    def __init__(self):
        self.known = 0
        self.least = np.full(WIDTH, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.by_bin: list[list[int]] = [[] for _ in range(WIDTH)]

    def grow(self, length: int) -> None:
        while self.known < length:
            j = np.arange(self.known, self.known + (1 << 16), dtype=np.uint64)
            bins, rank = (_mix(j, 1) % np.uint64(WIDTH)).astype(np.int64), _mix(j, 2)
            good = np.flatnonzero(rank < self.least[bins])
            for k in good:
                if rank[k] < self.least[bins[k]]:
                    self.least[bins[k]] = rank[k]
                    self.by_bin[bins[k]].append(int(j[k]))
            self.known += 1 << 16

    def upto(self, length: int):
        self.grow(length)
        return np.array(sorted(p for b in self.by_bin for p in b if p < length), dtype=np.int64)


def fingerprints(texts: list[str], places: Places) -> np.ndarray:
    """Symbols ``[len(texts), WIDTH]`` (0..15, or NONE)."""
    longest = max(map(len, texts), default=0)
    reach = 2 * longest + 16 * int((2 * longest) ** 0.5) + 256  # 16 deviations above the mean
    out, length = _fingerprints(texts, places, reach)
    if length > reach:
        out, _ = _fingerprints(texts, places, length)
    return out


def _fingerprints(texts: list[str], places: Places, reach: int) -> tuple[np.ndarray, int]:
    """Symbols from the places below ``reach``, and the longest written
    string's length."""
    n = np.array([len(t) for t in texts], dtype=np.int64)
    lanes = len(texts)
    out = np.full((lanes, WIDTH), NONE, dtype=np.uint8)
    if not lanes or not n.max():
        return out, 0
    gap = "\x00" * BLOCK  # overwritten by PAD: a walk may run this far past its text
    codes = np.frombuffer(gap.join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
    begin = np.concatenate([[0], np.cumsum(n + BLOCK)[:-1]])
    end = begin + n
    codes[(end[:, None] + np.arange(BLOCK)).ravel()] = PAD
    at = places.upto(reach)
    length = np.zeros(lanes, dtype=np.int64)
    row_of = {int(p): i for i, p in enumerate(at)}
    # places never reached hold the pad's symbol
    with np.errstate(over="ignore"):
        salts = (_mix(at.astype(np.uint64), 3) >> np.uint64(32)).astype(np.uint32)
        written = np.repeat((((PAD ^ salts) * np.uint32(MIX)) >> np.uint32(28)).astype(np.uint8)[:, None], lanes, axis=1)
        lane = np.flatnonzero(n)
        pos = begin[lane].copy()
        j = 0
        while len(lane) >= FEW_LANES:
            first = pos.copy()
            steps = (_mix(np.arange(j, j + BLOCK, dtype=np.uint64), 4) >> np.uint64(32)).astype(np.uint32)
            c = np.empty(len(lane), np.uint32)
            for k in range(BLOCK):
                np.take(codes, pos, out=c, mode="clip")
                i = row_of.get(j + k)
                if i is not None:
                    written[i, lane] = ((c ^ salts[i]) * np.uint32(MIX)) >> np.uint32(28)
                c += steps[k]
                c *= np.uint32(MIX)
                c >>= np.uint32(31)
                pos += c
            alive = pos < end[lane]
            if not alive.all():
                length[lane[~alive]] = j + _steps_left(codes, first[~alive], steps)
                lane, pos = lane[alive], pos[alive]
            j += BLOCK
        if len(lane):  # a few long texts: plain loops cost less than short arrays
            _walk_few(codes, lane, pos, end, length, j, at, salts, written)
    where = [np.array(b, dtype=np.int64) for b in places.by_bin]
    index = {int(p): i for i, p in enumerate(at)}
    for b, w in enumerate(where):
        w = w[w < reach] if len(w) else w
        if not len(w):
            continue
        rows = np.array([index[int(p)] for p in w])
        k = np.searchsorted(w, length, side="left") - 1
        has = k >= 0
        out[has, b] = written[rows[k[has]], np.flatnonzero(has)]
    return out, int(length.max())


def _steps_left(codes, pos, steps) -> np.ndarray:
    """Steps from ``pos`` to the end of texts that end within one block."""
    pos, left = pos.copy(), np.zeros(len(pos), dtype=np.int64)
    for step in steps:
        c = codes[pos]
        left += c != PAD
        pos += ((c + step) * np.uint32(MIX)) >> np.uint32(31)
    return left


def _walk_few(codes, lane, pos, end, length, start, at, salts, written) -> None:
    for i, p in zip(lane.tolist(), pos.tolist()):
        stop, j = int(end[i]), start
        nxt = int(np.searchsorted(at, j))
        text = codes[p:stop].tolist()
        size, p = len(text), 0
        while p < size:
            steps = (_mix(np.arange(j, j + 4096, dtype=np.uint64), 4) >> np.uint64(32)).tolist()
            place = int(at[nxt]) if nxt < len(at) else -1
            for s in steps:
                if p >= size:
                    break
                c = text[p]
                if j == place:
                    written[nxt, i] = (((c ^ int(salts[nxt])) * MIX) & 0xFFFFFFFF) >> 28
                    nxt += 1
                    place = int(at[nxt]) if nxt < len(at) else -1
                p += (((c + s) * MIX) & 0xFFFFFFFF) >> 31
                j += 1
        length[i] = j


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints, row by row: 0 unless some band of
    ``BAND`` neighbouring places agrees, else the share of agreeing places
    beyond chance. Places that neither has do not count; two fingerprints
    without places are alike."""
    same = a == b
    used = (a != NONE) | (b != NONE)
    band = same.reshape(len(a), -1, BAND).all(axis=2) & used.reshape(len(a), -1, BAND).any(axis=2)
    share = (same & used).sum(axis=1) / np.maximum(1, used.sum(axis=1))
    alike = np.clip((share - 1 / 16) / (15 / 16), 0, 1)
    return np.where(~used.any(axis=1), 1.0, np.where(band.any(axis=1), alike, 0.0))


def to_text(symbols: np.ndarray) -> list[str]:
    letters = np.frombuffer(b"0123456789abcdef-", dtype=np.uint8)
    return [bytes(r).decode() for r in letters[symbols]]


def edited(text: str, other: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as
    many (or all) of ``other``."""
    k = len(text) // 2
    return text[:len(text) - k] + other[:k]


def neighbours(docs: DataFrame) -> DataFrame:
    """``(bucket, peek, doc_id, text)``: documents dealt into ranges of
    descending ``doc_id``, each range followed by the first document of the
    next one (the last by the first of all) as ``peek`` rows. One shuffle of
    the texts; the range bounds are quantiles of the ids."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.min("doc_id").alias("lo")).first()
    parts = int(min(MAX_PARTITIONS, max(1, -(-(size["b"] or 0) // PARTITION_BYTES))))
    cuts: list[int] = []
    if parts > 1 and size["lo"] is not None:
        wanted = [(i + 1) / parts for i in range(parts - 1)]
        row = docs.select("doc_id").agg(F.percentile_approx("doc_id", wanted, 100 * parts).alias("q")).first()
        cuts = sorted(set(row["q"]))
    bounds = np.array(cuts, dtype=np.int64)
    count = len(cuts) + 1

    @F.pandas_udf("int")
    def bucket_of(ids):
        import pandas as pd

        # descending: the largest ids are in bucket 0, null ids come last
        at = count - 1 - np.searchsorted(bounds, ids.fillna(-2 ** 63).to_numpy().astype(np.int64), side="left")
        return pd.Series(at.astype(np.int32))

    if not cuts:
        dealt = docs.withColumn("bucket", F.lit(0))
    else:
        dealt = docs.withColumn("bucket", bucket_of("doc_id"))
    firsts = sorted((r["bucket"], r["top"]) for r in
                    dealt.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    before = {b: (firsts[i - 1][0], top) for i, (b, top) in enumerate(firsts)}
    heads = spark.createDataFrame([(b, top, prev) for b, (prev, top) in before.items()],
                                  f"_b int, _top {docs.schema['doc_id'].dataType.simpleString()}, _prev int")
    # one row per bucket: at most MAX_PARTITIONS rows
    marked = dealt.join(F.broadcast(heads), F.col("bucket") == F.col("_b"), "left")
    places = F.when(F.col("doc_id").eqNullSafe(F.col("_top")),
                    F.array(F.struct("bucket", F.lit(0).alias("peek")),
                            F.struct(F.col("_prev").alias("bucket"), F.lit(1).alias("peek")))
                    ).otherwise(F.array(F.struct("bucket", F.lit(0).alias("peek"))))
    spread = marked.select(F.explode(places).alias("p"), "doc_id", "text").select("p.bucket", "p.peek", "doc_id", "text")
    return (spread.repartitionById(max(count, 1), F.col("bucket"))
            .sortWithinPartitions("bucket", "peek", F.col("doc_id").desc_nulls_last(), "text"))


def edit_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. The next document
    follows in descending ``doc_id`` (null ids last, equal ids by text; after
    the last comes the first; a lone document is its own next). Null text:
    empty. Empty texts have a fingerprint without places; two such are
    alike (1.0). Walks go on to the end of every text. Equal texts have equal fingerprints.
    Empty table: no rows. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    rows = neighbours(docs)

    def run(batches):
        places = Places()
        id_type = None
        ids: list = []
        texts: list[str] = []  # one longer than ids: the last is only a next document

        def flush():
            new = [edited(t, o) for t, o in zip(texts, texts[1:])]
            both = fingerprints(texts + new, places)
            own, changed = both[:len(texts)], both[len(texts):]
            arrays = [pa.array(ids, type=id_type), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                      pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new]),
                      pa.array(to_text(own[:-1])), pa.array(to_text(changed)),
                      pa.array(likeness(own[:-1], changed)), pa.array(likeness(own[:-1], own[1:]))]
            ids.clear()
            del texts[:-1]
            return pa.RecordBatch.from_arrays(arrays, names=[
                "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        state = None  # (bucket, last own id) waiting for its next document
        size, done = 0, None
        for batch in batches:
            id_type = batch.schema.field(2).type
            for bucket, peek, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if peek and (done == bucket or state is None):
                    continue  # a further row of the next bucket's first id
                if state is not None:
                    ids.append(state[1])
                texts.append(text)
                size += len(text)
                if peek:  # the bucket is complete
                    yield flush()
                    texts.clear()
                    state, done, size = None, bucket, 0
                    continue
                state = (bucket, doc)
                if size >= BATCH_CHARS and ids:
                    yield flush()
                    size = len(text)

    return rows.mapInArrow(run, schema)
