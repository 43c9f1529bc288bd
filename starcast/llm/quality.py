"""Quality by the perplexity of an interpolated modified Kneser-Ney model.

Character n-grams of trusted documents are counted; every order's counts,
continuation counts and context sums are tables keyed by the n-gram and
joined by it, so the model is spread over the cluster like any table. Each
chunk of documents asks for its distinct n-grams once and scores its
documents from the joined answers. A document is kept if its perplexity
stays under a high quantile of its own language, taken over trusted documents
that the model was not trained on.
"""

from __future__ import annotations

import ctypes
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcast.llm.common import crc_mod, row_key, write_table
from starcast.session import scratch_path

ORDER = 5
CHUNK_ROWS = 8192           # a chunk ends at that many rows
CHUNK_BYTES = 48 * 2 ** 20  # or bytes of text, whichever comes first
BATCH_CHARS = 500_000       # characters whose n-grams are in memory together
CHAR_BITS = 12
SYMBOLS = 1 << CHAR_BITS
START, STOP = 2, 3
CALIBRATE_FOLDS = 5
HIGH = 0.985
MARGIN = 0.05
PSEUDO_CHARS = 50
SPREAD_ROWS = 2  # rows that the spread within all languages counts for beside a language's own
BROADCAST_IDS = 1_000_000


def symbols(pieces: list[str]) -> np.ndarray:
    """Symbol codes of strings, one after the other. Characters from 4000 on
    are folded to 96 classes by their block of 256, so a symbol fits 12 bits."""
    codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(codes < 4000, codes, 4000 + (codes >> 8) % 96).astype(np.int64)


def pieces(text: str, limit: int = BATCH_CHARS):
    """A text after ORDER - 1 start marks and before a stop mark, cut so that
    every n-gram lies in exactly one piece of about ``limit`` characters."""
    whole = "\x02" * (ORDER - 1) + text + "\x03"
    for at in range(0, len(text) + 1, limit):
        yield whole[at:at + limit + ORDER - 1]


def grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of all pieces in order, and n-grams per piece."""
    codes = symbols(parts)
    size = np.array([len(p) for p in parts], dtype=np.int64)
    n = size - (ORDER - 1)
    keys = np.zeros(max(0, len(codes) - ORDER + 1), dtype=np.int64)
    for k in range(ORDER):
        keys = (keys << CHAR_BITS) | codes[k:len(codes) - ORDER + 1 + k]
    at = np.repeat((ORDER - 1) * np.arange(len(parts)), n) + np.arange(n.sum())
    return keys[at], n


def _freed() -> None:
    """Hand freed memory back to the system: workers are kept for later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:
        pass  # no glibc here


class _Chunks:
    """Chunk numbers along an input partition: the id of a chunk's first row.
    A chunk ends at ``rows`` rows or ``size`` bytes, and with the partition."""

    def __init__(self, rows: int, size: int):
        self.limit, self.now, self.rows, self.bytes = (rows, size), None, 0, 0

    def of(self, row_id: int, size: int) -> int:
        full = self.rows >= self.limit[0] or (self.rows and self.bytes + size > self.limit[1])
        if self.now is None or full or row_id >> 33 != self.now >> 33:
            self.now, self.rows, self.bytes = row_id, 0, 0
        self.rows += 1
        self.bytes += size
        return self.now


def _numbered(docs: DataFrame) -> DataFrame:
    """Documents with their place in the input (partition and row)."""
    return docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "doc_id",
                       F.col("lang").cast("string").alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("place"))


def _batched(texts, limit: int = BATCH_CHARS):
    """``(number of the text, piece)`` lists of about ``limit`` characters."""
    part, size = [], 0
    for i, t in enumerate(texts):
        for piece in pieces(t, limit):
            part.append((i, piece))
            size += len(piece)
            if size >= limit:
                yield part
                part, size = [], 0
    if part:
        yield part


def chunk_grams(flagged: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk, gram, n)``: distinct n-grams of a chunk and how often its
    training rows (``train``) hold them."""
    def merge(a, b):
        keys = np.concatenate([a[0], b[0]])
        counts = np.concatenate([a[1], b[1]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[head], np.add.reduceat(counts, head) if len(head) else counts[:0]

    def run(batches):
        now, state, waiting, size = None, None, ([], []), 0
        chunks = _Chunks(chunk_rows, chunk_bytes)

        def absorb():
            nonlocal state, waiting, size
            for train, texts in enumerate(waiting):
                for part in _batched(texts):
                    keys, times = np.unique(grams([p for _, p in part])[0], return_counts=True)
                    add = (keys, times * train)
                    state = add if state is None else merge(state, add)
            waiting, size = ([], []), 0

        def send():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(state[0]), now, dtype=np.int64)), pa.array(state[0]), pa.array(state[1])],
                names=["chunk", "gram", "n"])

        for batch in batches:
            for text, train, place, length in zip(batch.column(0), *(batch.column(i).to_pylist() for i in range(1, 4))):
                chunk = chunks.of(place, length)
                if chunk != now:
                    if now is not None:
                        absorb()
                        yield send()
                    now, state = chunk, None
                waiting[bool(train)].append(text.as_py())
                size += length
                if size >= BATCH_CHARS:
                    absorb()
        if now is not None:
            absorb()
            yield send()
        state = None
        _freed()

    return (flagged.select("text", "train", "place", F.octet_length("text").alias("bytes"))
            .mapInArrow(run, "chunk bigint, gram bigint, n bigint"))


def pack_rows(numbered: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES,
              block_rows: int = 512) -> DataFrame:
    """``(chunk, block)``: the rows of a chunk as compressed Arrow blocks,
    about half the bytes of plain rows in the shuffle that follows."""
    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        numbers = _Chunks(chunk_rows, chunk_bytes)
        for batch in batches:
            chunks = np.array([numbers.of(p, b) for p, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())])
            edges = np.flatnonzero(np.diff(chunks)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(chunks)]):
                for a in range(lo, hi, block_rows):
                    part = batch.slice(a, min(block_rows, hi - a)).select(range(4))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                        out.write_batch(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(chunks[lo])]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                        names=["chunk", "block"])

    return (numbered.select("row", "doc_id", "lang", "text", "place", F.octet_length("text").alias("bytes"))
            .mapInArrow(run, "chunk bigint, block binary"))


def _suffix(gram, order: int):
    """The n-gram of ``order`` symbols that ends a longer one."""
    return gram.bitwiseAND(F.lit((1 << (CHAR_BITS * order)) - 1))


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and from 3 on."""
    row = counts.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in range(1, 5))
    if not (n1 and n2 and n3):
        return [0.0, 0.5, 0.75, 0.9]  # too little text to estimate them
    y = n1 / (n1 + 2 * n2)
    return [0.0, min(1, max(0, 1 - 2 * y * n2 / n1)), min(2, max(0, 2 - 3 * y * n3 / n2)),
            min(3, max(0, 3 - 4 * y * n4 / n3))]


def log_probabilities(asked: DataFrame, trusted: DataFrame) -> DataFrame:
    """``(gram, logp)``: natural log probability of the last symbol of every
    distinct n-gram in ``asked(gram)`` after the others, under the model of
    ``trusted(gram, n)``.

    Orders go from 1 up. At each, the asked n-grams' endings of that order
    join the counts, the context sums and the lower order's probabilities;
    all of them are distinct by key, so no key is hot. Unseen contexts pass
    the lower order on. Below order 1 all symbols are equally likely."""
    counts = {ORDER: trusted}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = write_table(counts[k + 1].groupBy(_suffix(F.col("gram"), k).alias("gram"))
                                .agg(F.count(F.lit(1)).alias("n")), "kn-counts")
    wanted = {ORDER: asked}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = write_table(wanted[k + 1].select(_suffix(F.col("gram"), k).alias("gram")).distinct(), "kn-asked")
    lower = None
    for k in range(1, ORDER + 1):
        d = _discounts(counts[k])
        off = F.when(F.col("n") == 1, d[1]).when(F.col("n") == 2, d[2]).otherwise(d[3])
        context = counts[k].groupBy(F.shiftright("gram", CHAR_BITS).alias("c")).agg(
            F.sum("n").alias("total"), F.sum(off).alias("taken"))
        rows = wanted[k].join(counts[k], "gram", "left").withColumn("c", F.shiftright("gram", CHAR_BITS))
        if k == 1:
            rows = rows.crossJoin(F.broadcast(context.select("total", "taken"))) if counts[1].take(1) else \
                rows.withColumn("total", F.lit(None).cast("bigint")).withColumn("taken", F.lit(None).cast("double"))
            below = F.lit(1.0 / SYMBOLS)
        else:
            rows = (rows.join(context, "c", "left").withColumn("s", _suffix(F.col("gram"), k - 1))
                    .join(lower.select(F.col("gram").alias("s"), F.col("p").alias("below")), "s"))
            below = F.col("below")
        seen = F.when(F.col("n").isNull(), 0.0).otherwise(F.col("n") - off)
        p = F.when(F.col("total").isNull(), below).otherwise((seen + F.col("taken") * below) / F.col("total"))
        lower = write_table(rows.select("gram", p.alias("p")), "kn-p")
    return lower.select("gram", F.log("p").cast("float").alias("logp"))


def perplexities(docs: DataFrame, trusted_ids: DataFrame, *, chunk_rows: int = CHUNK_ROWS,
                 chunk_bytes: int = CHUNK_BYTES, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``(row, doc_id, lang, calibrates, n, perplexity)`` of every row, under the
    model of the rows whose id is in ``trusted_ids(doc_id)`` and outside the
    calibration fold; ``calibrates`` marks trusted rows of that fold.
    ``row`` is ``common.row_key``. The perplexity is per character, the end
    of the text included (empty text: of the end alone). ``docs`` is read
    twice and must give the same rows in the same partitions (files)."""
    ids = write_table(trusted_ids.select(F.col("doc_id").alias("_t")).where("_t is not null").distinct(), "kn-trusted")
    numbered = _numbered(docs)
    fold = crc_mod(F.col("doc_id"), CALIBRATE_FOLDS) == 0
    if ids.count() <= broadcast_ids:
        flagged = numbered.join(F.broadcast(ids), F.col("doc_id") == F.col("_t"), "left")
    else:  # back to the input's partitions and order, so that chunks come out alike
        flagged = (numbered.join(ids, F.col("doc_id") == F.col("_t"), "left")
                   .repartition(F.shiftright("place", 33)).sortWithinPartitions("place"))
    flagged = flagged.withColumn("train", F.col("_t").isNotNull() & ~fold)
    at = scratch_path(docs.sparkSession, "kn-grams")
    chunk_grams(flagged, chunk_rows, chunk_bytes).write.option("compression", "zstd").parquet(at)
    found = docs.sparkSession.read.parquet(at)
    totals = write_table(found.groupBy("gram").agg(F.sum("n").alias("n")), "kn-counts")
    answers = found.select("chunk", "gram").join(
        log_probabilities(totals.select("gram"), totals.where("n > 0")), "gram")

    def scored(key, packed: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        known, logp = got["gram"].to_numpy(), got["logp"].to_numpy()
        order = np.argsort(known, kind="stable")
        known, logp = known[order], logp[order]
        out = []
        for block in packed["block"]:
            rows = pa.ipc.open_stream(block).read_all()
            size = np.zeros(rows.num_rows, dtype=np.int64)
            total = np.zeros(rows.num_rows)
            for part in _batched(t.as_py() for t in rows.column("text").combine_chunks()):
                keys, n = grams([p for _, p in part])
                each = logp[np.searchsorted(known, keys)].astype(np.float64)
                owner = [i for i, _ in part]
                np.add.at(size, owner, n)
                np.add.at(total, owner, np.add.reduceat(each, np.concatenate([[0], np.cumsum(n)[:-1]])))
            frame = rows.select(["row", "doc_id", "lang"]).to_pandas()
            out.append(frame.assign(n=size, perplexity=np.exp(-total / size)))
        del known, logp, order
        _freed()
        return pd.concat(out, ignore_index=True)

    kind = docs.schema["doc_id"].dataType.simpleString()
    result = (pack_rows(numbered, chunk_rows, chunk_bytes).groupBy("chunk").cogroup(answers.groupBy("chunk"))
              .applyInPandas(scored, f"row bigint, doc_id {kind}, lang string, n bigint, perplexity double"))
    result = write_table(result, "kn-perplexity")
    marked = result.join(ids, F.col("doc_id") == F.col("_t"), "left")
    return marked.select("row", "doc_id", "lang", (F.col("_t").isNotNull() & fold).alias("calibrates"), "n", "perplexity")


def _bounds(scored: DataFrame, high: float) -> DataFrame:
    """``(l, q)`` of every language of ``scored(lang, judged, calibrates)``:
    the ``high`` quantile of ``judged`` over its calibration rows.

    One rule for any number m of rows: the larger of their order statistic
    and Student's prediction limit of one more row on the log scale, by
    their mean and their variance with the pooled variance within languages
    added as ``SPREAD_ROWS`` rows. A language without calibration rows has
    the median of its own documents in the place of the mean. Where no
    language has two calibration rows, the pooled spread is that of all
    documents around their languages' medians (by quartiles)."""
    log = F.log("judged")
    own = F.when(F.col("calibrates"), log)
    stats = write_table(scored.groupBy(F.col("lang").alias("l")).agg(
        F.count(own).alias("m"), F.percentile_approx(F.when(F.col("calibrates"), F.col("judged")), high, 10000).alias("order"),
        F.avg(own).alias("mean"), F.coalesce(F.var_pop(own), F.lit(0.0)).alias("var"), F.count(log).alias("n"),
        F.percentile_approx(log, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000).alias("middle")), "kn-languages")
    quartile = (F.col("middle")[2] - F.col("middle")[0]) / 1.349
    sums = stats.agg(F.sum(F.col("m") * F.col("var")).alias("within"), F.sum(F.greatest(F.col("m") - 1, F.lit(0))).alias("free"),
                     F.sum(F.col("n") * quartile * quartile).alias("all"), F.sum("n").alias("n")).first()
    pooled = sums["within"] / sums["free"] if sums["free"] else sums["all"] / sums["n"] if sums["n"] else 0.0
    z = NormalDist().inv_cdf(high)
    free = F.greatest(F.col("m") - 1, F.lit(0)) + SPREAD_ROWS
    spread = F.sqrt((F.lit(SPREAD_ROWS * float(pooled)) + F.col("m") * F.col("var")) / free)
    # Student's quantile by its expansion
    t = (z + (z ** 3 + z) / 4 / free + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96 / F.pow(free, 2)
         + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384 / F.pow(free, 3))
    centre = F.coalesce(F.col("mean"), F.col("middle")[1])
    limit = F.exp(centre + t * spread * F.sqrt(1 + 1 / F.greatest(F.col("m"), F.lit(1))))
    return stats.select("l", F.greatest("order", limit).alias("q"))


def judge(docs: DataFrame, trusted_ids: DataFrame, *, high: float = HIGH, margin: float = MARGIN,
          pseudo_chars: int = PSEUDO_CHARS, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES,
          broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``(row, doc_id, lang, perplexity, judged, high, keep)`` of every row.

    A short text's average says little, so ``judged`` mixes
    ``pseudo_chars`` characters of the calibration rows' median (without
    such rows: of all rows' median) into the perplexity. A row is kept if
    that is at most its language's bound (``_bounds``; null is a language),
    widened by ``margin`` (a share). Without any trusted row the model is
    uniform and every row is kept. Null text counts as empty; long texts are
    read whole, in pieces. Repeated rows get equal results. Empty table: no
    rows."""
    scored = write_table(perplexities(docs, trusted_ids, chunk_rows=chunk_rows, chunk_bytes=chunk_bytes,
                                      broadcast_ids=broadcast_ids), "kn-scored")
    middles = scored.agg(F.percentile_approx(F.when(F.col("calibrates"), F.col("perplexity")), 0.5, 10000).alias("own"),
                         F.percentile_approx("perplexity", 0.5, 10000).alias("all")).first()
    middle = middles["own"] or middles["all"] or 1.0
    mixed = F.exp((F.col("n") * F.log("perplexity") + F.lit(pseudo_chars * float(np.log(middle))))
                  / (F.col("n") + pseudo_chars))
    scored = scored.withColumn("judged", mixed)
    bounds = write_table(_bounds(scored, high), "kn-bounds")
    joined = scored.join(bounds, F.col("lang").eqNullSafe(F.col("l")), "left")
    return (joined.withColumn("high", F.col("q") * (1 + margin)).withColumn("keep", F.col("judged") <= F.col("high"))
            .select("row", "doc_id", "lang", "perplexity", "judged", "high", "keep"))


def keep_good(docs: DataFrame, trusted_ids: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns. The
    smaller side of the decision, the rejected rows, is joined."""
    rejected = judge(docs, trusted_ids, **options).where("not keep").select(F.col("row").alias("r"), F.col("doc_id").alias("k")).distinct()
    # the documents as one struct, so that no name of theirs can clash
    held = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), row_key(F.col("doc_id"), F.col("text")).alias("row"))
    return held.join(rejected, (F.col("row") == F.col("r")) & F.col("id").eqNullSafe(F.col("k")), "left_anti").select("doc.*")
