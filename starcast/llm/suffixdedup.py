"""Removal of repeated byte strings by longest-previous-factor arrays.

Suffixes are sorted only where a repeat can be. Every window of ``span``
bytes picks the least hash among its grams as its anchor; equal windows pick
equal anchors, so neighbouring windows with one anchor (a run, about
``span`` x 3/8 windows) are the unit that is counted, joined and shipped:

1. Anchors are counted. One that is found once repeats nothing.
2. Runs of an anchor that always has the same bytes around it are repeats as
   a whole. No text is needed for them.
3. Of the other anchors every distinct run is shipped once, to a bucket of
   bounded size. There its windows are put in suffix order; the neighbouring
   longest common prefixes and the previous and next smaller positions give
   the longest previous factor of each window, and by turning the positions
   round the longest next one.

An anchor with more distinct runs than a bucket may hold is resolved window
by window through a 128-bit hash and an aggregation instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcast.llm.common import write_table

SPAN = 200
SEGMENT = 1 << 20       # windows looked at together
BUCKET_BYTES = 2 * 2 ** 20
HOT_RUNS = 4096         # runs of one anchor that a bucket may hold
OUTPUT_BYTES = 8 * 2 ** 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE_BITS = 24


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every ``size`` bytes."""
    n = len(data)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    h = (sums[size:] - sums[:-size]) * _powers(_INVERSE, n - size + 1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    n = len(keys)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(data: bytes, span: int = SPAN) -> list[tuple[int, int, int, int, int]]:
    """``(anchor, content, start, count, times)``: the windows of a text as
    runs of ``count`` windows from ``start`` on that share an anchor.
    ``content`` hashes all bytes of the run. Equal runs that follow each other
    (periodic text) are one entry, ``times`` of them."""
    gram = max(1, span // 4)
    raw = np.frombuffer(data, dtype=np.uint8)
    out: list = []
    low = np.uint64((1 << _PLACE_BITS) - 1)
    for base in range(0, max(0, len(data) - span + 1), SEGMENT):
        part = raw[base:base + SEGMENT + span - 1]
        h = rolling(part, gram)
        keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        place = (_sliding_least(keys, span - gram + 1) & low).astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
        marks = h[place[edges[:-1]]].view(np.int64).tolist()
        edges = (edges + base).tolist()
        for mark, a, b in zip(marks, edges, edges[1:]):
            content = xxhash.xxh3_64_intdigest(data[a:b - 1 + span]) - (1 << 63)
            if out and out[-1][0] == mark and out[-1][1] == content and out[-1][3] == b - a:
                out[-1][4] += 1
            else:
                out.append([mark, content, a, b - a, 1])
    return out


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("monotonically_increasing_id() as row", "doc_id",
                           "coalesce(cast(cast(text as string) as binary), cast('' as binary)) as text")


_RUNS = "row bigint, anchor bigint, content bigint, start int, count int, times int"


def _all_runs(numbered: DataFrame, span: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = runs(text.as_py(), span)
                for at in range(0, len(found), 100_000):
                    part = np.array(found[at:at + 100_000], dtype=np.int64)
                    columns = [np.full(len(part), row), part[:, 0], part[:, 1], *(part[:, i].astype(np.int32) for i in (2, 3, 4))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                                     names=["row", "anchor", "content", "start", "count", "times"])

    return numbered.select("row", "text").mapInArrow(run, _RUNS)


def _packed(numbered: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle."""
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [squeeze.compress(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())],
                                             names=["row", "doc_id", "packed"])

    kind = numbered.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(run, f"row bigint, doc_id {kind}, packed binary")


def _pieces(numbered: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """``(anchor, content, row, start, hot, piece)``: the bytes of the wanted
    runs ``(row, anchor, content, start, count, hot)``."""
    lists = wanted.groupBy(F.col("row").alias("r")).agg(
        F.collect_list(F.struct("anchor", "content", "start", "count", "hot")).alias("runs"))

    def run(batches):
        expand = zstandard.ZstdDecompressor()
        names = ["anchor", "content", "row", "start", "hot", "piece"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
        for batch in batches:
            out, held = [], 0
            for row, packed, found in zip(*(batch.column(i) for i in range(3))):
                text = expand.decompress(packed.as_py())
                for r in found.as_py():
                    piece = text[r["start"]:r["start"] + r["count"] - 1 + span]
                    out.append((r["anchor"], r["content"], row.as_py(), r["start"], r["hot"], piece))
                    held += len(piece)
                    if held >= OUTPUT_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    joined = _packed(numbered).join(lists, F.col("row") == F.col("r")).select("row", "packed", "runs")
    return joined.mapInArrow(run, "anchor bigint, content bigint, row bigint, start int, hot boolean, piece binary")


def suffix_order(text: bytes, places: list[int], span: int) -> list[int]:
    """Places in the order of the ``span`` bytes from them on; ties by place."""
    return sorted(places, key=lambda p: text[p:p + span])


def common_prefixes(text: bytes, order: list[int], span: int, block: int = 20_000) -> np.ndarray:
    """Common bytes, up to ``span``, of each place in the order with the one
    before it (the first: 0)."""
    raw = np.frombuffer(text, dtype=np.uint8)
    at = np.array(order, dtype=np.int64)
    out = np.zeros(len(at), dtype=np.int64)
    for lo in range(1, len(at), block):
        hi = min(lo + block, len(at))
        step = np.arange(span)
        differ = raw[at[lo - 1:hi - 1, None] + step] != raw[at[lo:hi, None] + step]
        out[lo:hi] = np.where(differ.any(axis=1), differ.argmax(axis=1), span)
    return out


def previous_factors(order, prefixes) -> dict[int, int]:
    """Longest previous factor of every place: the longer common prefix with
    the previous and the next smaller place in suffix order. An entry leaves
    the stack when its next smaller place comes up; what lies under it then
    is its previous smaller one."""
    out: dict[int, int] = {}
    stack: list[tuple[int, int]] = []
    for place, common in [*zip(order, prefixes), (None, 0)]:
        while stack and (place is None or stack[-1][0] > place):
            top, before = stack.pop()
            out[top] = max(before, common)
            common = min(before, common)
        if place is not None:
            stack.append((place, common))
    return out


def _as_runs(flags: np.ndarray) -> list[int]:
    """Flat ``[first, length, ...]`` of the true stretches."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [x for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) for x in (a, b - a)]


def resolve(pieces: list[bytes], span: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For pieces in order of position: which windows of each were seen
    earlier, and which come again later."""
    text = b"".join(pieces)
    sizes = np.array([len(p) - span + 1 for p in pieces], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]]).astype(np.int64)
    places = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    hashes = rolling(np.frombuffer(text, dtype=np.uint8), span)[places]
    _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
    maybe = places[times[back] > 1]  # other windows' factors are shorter than the span
    order = suffix_order(text, maybe.tolist(), span)
    prefixes = common_prefixes(text, order, span).tolist()
    earlier, later = (np.zeros(len(text), dtype=bool) for _ in range(2))
    for place, length in previous_factors(order, prefixes).items():
        earlier[place] = length >= span
    for place, length in previous_factors([-p for p in order], prefixes).items():
        later[-place] = length >= span
    return [(earlier[a:a + n], later[a:a + n]) for a, n in zip(starts, sizes)]


_PARTIAL = "anchor bigint, content bigint, some array<int>"


def _in_buckets(pieces: DataFrame, span: int, buckets: int, keep_first: bool) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "start"], kind="stable")
        found = [_as_runs(earlier if keep_first else earlier | later) for earlier, later in resolve(pdf["piece"].tolist(), span)]
        out = pd.DataFrame({"anchor": pdf["anchor"].to_numpy(), "content": pdf["content"].to_numpy(), "some": found})
        return out[[bool(x) for x in found]]

    return (pieces.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
            .groupBy("bucket").applyInPandas(run, _PARTIAL))


def _by_window(pieces: DataFrame, span: int, keep_first: bool) -> DataFrame:
    """The same for anchors with any number of runs: windows are counted by
    their 128-bit hash, combined before the shuffle."""
    def run(batches):
        for batch in batches:
            for anchor, content, row, start, piece in zip(*(batch.column(i) for i in range(5))):
                data = piece.as_py()
                n = len(data) - span + 1
                hashes = [xxhash.xxh3_128_digest(data[j:j + span]) for j in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.as_py()] * n, pa.int64()) for x in (anchor, content, row)]
                    + [pa.array(range(start.as_py(), start.as_py() + n), pa.int32()), pa.array(range(n), pa.int32()),
                       pa.array(hashes, pa.binary())],
                    names=["anchor", "content", "row", "place", "j", "hash"])

    windows = write_table(pieces.select("anchor", "content", "row", "start", "piece").mapInArrow(
        run, "anchor bigint, content bigint, row bigint, place int, j int, hash binary"), "suffix-windows")
    seen = (windows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "place")).alias("first"))
            .where("n > 1"))
    hits = windows.join(seen, "hash")
    if keep_first:
        hits = hits.where(F.struct("row", "place") != F.col("first"))
    marked = hits.groupBy("anchor", "content").agg(F.array_sort(F.collect_set("j")).alias("at"))
    pairs = F.transform("at", lambda j: F.array(j, F.lit(1)))
    return marked.select("anchor", "content", F.flatten(pairs).alias("some"))


def repeated_spans(numbered: DataFrame, *, span: int = SPAN, keep_first: bool = False, bucket_bytes: int = BUCKET_BYTES,
                   hot_runs: int = HOT_RUNS) -> DataFrame:
    """``(row, spans)``: flat ``[start, stop, ...]`` byte ranges, unordered, of
    the rows ``(row, text)`` that hold repeated windows."""
    every = write_table(_all_runs(numbered, span), "suffix-all-runs")
    anchors = (every.groupBy("anchor").agg(F.sum("times").alias("n"), F.min("content").alias("a"), F.max("content").alias("b"))
               .where("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("mixed")))
    found = write_table(every.join(anchors, "anchor"), "suffix-runs")
    kinds = (found if keep_first else found.where("mixed")).groupBy("anchor", "content").agg(
        F.sum("times").alias("n"), F.min(F.struct("row", "start")).alias("first"),
        F.max("mixed").alias("mixed"), F.max("count").alias("count"))
    kinds = write_table(kinds, "suffix-kinds")
    # a run that repeats as a whole need not be looked into, unless its first copy may have met others before
    mixed = kinds.where("mixed").select(F.col("first.row").alias("row"), "anchor", "content",
                                        F.col("first.start").alias("start"), "count")
    dense = mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > hot_runs).select("anchor", F.lit(True).alias("hot"))
    wanted = mixed.join(dense, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    pieces = write_table(_pieces(numbered, wanted, span), "suffix-pieces")
    size = pieces.agg(F.sum(F.when(~F.col("hot"), F.octet_length("piece"))).alias("cold"),
                      F.count(F.when(F.col("hot"), 1)).alias("hot")).first()
    buckets = max(1, -(-(size["cold"] or 0) // bucket_bytes))
    partial = _in_buckets(pieces.where("not hot"), span, buckets, keep_first)
    if size["hot"]:
        partial = partial.unionByName(_by_window(pieces.where("hot"), span, keep_first))
    partial = write_table(partial, "suffix-partial")

    def bytes_of(first, windows):
        return F.array(first, first + windows + (span - 1))

    length = F.col("count") * F.col("times")
    known = kinds.select("anchor", "content", "n", "first").join(partial, ["anchor", "content"], "left")
    rows = (found if keep_first else found.where("mixed")).join(known, ["anchor", "content"])
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("some") / 2).cast("int") - 1),
                        lambda i: bytes_of(F.col("start") + F.get("some", 2 * i), F.get(F.col("some"), 2 * i + 1)))
    within = F.when(F.size("some") > 0, F.flatten(pairs)).otherwise(F.array().cast("array<int>"))
    if keep_first:
        again = F.when(F.col("times") > 1, bytes_of(F.col("start") + F.col("count"), length - F.col("count"))).otherwise(
            F.array().cast("array<int>"))
        own = F.struct("row", "start") == F.col("first")
        spans = rows.select("row", F.when(own, F.concat(within, again)).otherwise(bytes_of(F.col("start"), length)).alias("spans"))
    else:
        spans = rows.select("row", F.when(F.col("n") > 1, bytes_of(F.col("start"), length)).otherwise(within).alias("spans"))
        spans = spans.unionByName(found.where("not mixed").select("row", bytes_of(F.col("start"), length).alias("spans")))
    return spans.where(F.size("spans") > 0).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    """Maximal ranges of flat, unordered ones; touching ranges are one."""
    pairs = np.array(spans, dtype=np.int64).reshape(-1, 2)
    if not len(pairs):
        return []
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    heads = np.concatenate([[0], np.flatnonzero(pairs[1:, 0] > reach[:-1]) + 1])
    tails = np.concatenate([heads[1:], [len(pairs)]]) - 1
    return list(zip(pairs[heads, 0].tolist(), reach[tails].tolist()))


def remove_repeats(docs: DataFrame, *, span: int = SPAN, keep_first: bool = True, bucket_bytes: int = BUCKET_BYTES,
                   hot_runs: int = HOT_RUNS) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans, spans, kept_sha256`` of every
    row of ``docs(doc_id, text)``; ``kept`` is bytes, ``spans`` the maximal
    removed ranges as ``[start, stop]``.

    A byte goes if a string of ``span`` bytes that covers it also starts
    earlier in the table (``keep_first``: the first copy stays), or anywhere
    else. The order is that of the input. Strings lie within one text's UTF-8
    bytes, overlap freely and are judged on the input. Null text: empty.
    Texts shorter than ``span`` stay as they are. Repeated rows are copies of
    each other; ids play no part. Long texts are read whole, in segments
    that overlap. Other columns are not read. Empty table: no rows.

    ``docs`` is read several times and must give the same rows in the same
    partitions (files or a checkpoint). Runs of one anchor are told apart by
    64-bit hashes of all their bytes.
    """
    numbered = _numbered(docs)
    spans = repeated_spans(numbered, span=span, keep_first=keep_first, bucket_bytes=bucket_bytes, hot_runs=hot_runs)
    joined = _packed(numbered).join(spans.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        expand = zstandard.ZstdDecompressor()
        names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"]
        for batch in batches:
            first, rows, held = 0, [], 0
            for i in range(batch.num_rows):
                text = expand.decompress(batch.column(1)[i].as_py())
                gone = merged(batch.column(2)[i].as_py() or [])
                edges = [0, *(x for pair in gone for x in pair), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((kept, len(text), len(text) - len(kept), len(gone), [list(g) for g in gone],
                             hashlib.sha256(kept).hexdigest()))
                held += len(kept)
                if held >= OUTPUT_BYTES or i == batch.num_rows - 1:
                    types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.string()]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i + 1 - first),
                                                      *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=names)
                    first, rows, held = i + 1, [], 0

    return joined.select("doc_id", "packed", "spans").mapInArrow(
        run, f"doc_id {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<array<int>>, "
             "kept_sha256 string")
