"""Document scores by a deleted-interpolation word bigram model.

A token's probability mixes the bigram and unigram maximum-likelihood
estimates with a uniform floor; the weights depend on how often the context
was seen and are learned by expectation-maximisation on held-out counts
(one whole fold of the training documents, a seventh of all documents, left
out of the estimates meanwhile).

Counts move in packed form. Every chunk of documents sends its distinct
n-gram keys and counts, sorted and packed into one array per shard; a shard
sums them over all chunks and answers each chunk with the totals of its
keys. A chunk then scores its documents from the answers. Nothing but
bounded statistics reaches the driver.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcast.llm.common import crc_mod, write_table

FOLDS, HELD_FOLD, EM_FOLD = 7, 2, 4
CHUNK_ROWS = 2048
SHARD_BYTES = 32 * 2 ** 20  # text whose requests one summing group holds
BUCKETS = 24
END = np.uint64(0xE703E703E703E703)
START = np.uint64(0x57A2757A2757A275)
BINS_PER_OCTAVE = 4
EM_STEPS = 60


def tokens(text: bytes) -> np.ndarray:
    """64-bit keys of the words of a text (A-Z lower-cased) and its end."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def sequence(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token keys, their predecessors' keys and tokens per document."""
    docs = [tokens(t or b"") for t in texts]
    size = np.array([len(d) for d in docs], dtype=np.int64)
    if not len(docs):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), size
    word = np.concatenate(docs)
    before = np.concatenate([[START], word[:-1]])
    before[np.cumsum(size)[:-1]] = START
    return word, before, size


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (before * np.uint64(0x9E3779B97F4A7C15)) ^ word
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _pack(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u4").tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype="<u4").astype(np.int64)


def _chunked(docs: DataFrame, chunk_rows: int) -> DataFrame:
    """Documents with their fold flags and a chunk number: a run of rows of
    one input partition (odd: the run's EM documents)."""
    held = crc_mod(F.col("doc_id"), FOLDS) == HELD_FOLD
    em = F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == EM_FOLD, F.lit(False))
    shift = chunk_rows.bit_length() - 1
    return (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
            .withColumn("run", F.shiftright(F.monotonically_increasing_id(), shift))
            .select("doc_id", "text", held.alias("held"), em.alias("em"),
                    (F.col("run") * 2 + em.cast("bigint")).alias("chunk")))


def _requests(chunked: DataFrame, shards: int) -> DataFrame:
    schema = "shard int, size int, chunk bigint, keys binary, counts binary"

    def ask(chunk, texts, held):
        word, before, size = sequence(texts)
        train = np.repeat(~np.array(held, dtype=bool), size)
        for n, keys in ((1, word), (2, pair_keys(before, word))):
            all_keys = np.unique(keys)
            seen, times = np.unique(keys[train], return_counts=True)
            counts = np.zeros(len(all_keys), dtype=np.int64)
            counts[np.searchsorted(all_keys, seen)] = times
            shard = all_keys % np.uint64(shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
            for s in np.flatnonzero(np.diff(cuts)):
                pick = order[cuts[s]:cuts[s + 1]]
                yield int(s), n, chunk, all_keys[pick].astype("<u8").tobytes(), _pack(counts[pick])

    def run(batches):
        def send(chunk, rows):
            cols = list(zip(*ask(chunk, [r[0] for r in rows], [r[1] for r in rows])))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())],
                names=["shard", "size", "chunk", "keys", "counts"])

        waiting: dict[int, list] = {}
        for batch in batches:
            for text, held, chunk in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if chunk not in waiting:  # chunk numbers grow: earlier runs are complete
                    for c in [c for c in waiting if c >> 1 != chunk >> 1]:
                        yield send(c, waiting.pop(c))
                waiting.setdefault(chunk, []).append((text, held))
        for c in list(waiting):
            yield send(c, waiting.pop(c))

    return chunked.select("text", "held", "chunk").mapInArrow(run, schema)


def _answers(requests: DataFrame) -> DataFrame:
    """Per chunk and shard the totals of the requested keys (``train``), and
    for EM chunks those without the EM documents (``rest``); one row per
    shard with chunk -1 sums up tokens and distinct words."""
    schema = ("shard int, size int, chunk bigint, train binary, rest binary, "
              "tokens bigint, words bigint, rest_tokens bigint, rest_words bigint")

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, dtype="<u8") for k in pdf["keys"]]
        counts = [_unpack(c) for c in pdf["counts"]]
        em = np.repeat(pdf["chunk"].to_numpy() % 2 == 1, [len(k) for k in keys])
        own = np.concatenate(counts)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        train = np.bincount(at, weights=own, minlength=len(distinct)).astype(np.int64)
        rest = train - np.bincount(at[em], weights=own[em], minlength=len(distinct)).astype(np.int64)
        shard, size = int(pdf["shard"].iloc[0]), int(pdf["size"].iloc[0])
        rows, lo = [], 0
        for chunk, k in zip(pdf["chunk"], keys):
            part = at[lo:lo + len(k)]
            lo += len(k)
            rows.append((shard, size, chunk, _pack(train[part]), _pack(rest[part]) if chunk % 2 else None,
                         None, None, None, None))
        if size == 1:
            rows.append((shard, size, -1, None, None, int(train.sum()), int((train > 0).sum()),
                         int(rest.sum()), int((rest > 0).sum())))
        return pd.DataFrame(rows, columns=["shard", "size", "chunk", "train", "rest", "tokens", "words",
                                           "rest_tokens", "rest_words"]).astype(
            {c: "Int64" for c in ("tokens", "words", "rest_tokens", "rest_words")})

    return requests.groupBy("size", "shard").applyInPandas(total, schema)


class _Counts:
    """Counts of a chunk's tokens, contexts and pairs from its answers."""

    def __init__(self, texts, answers: pd.DataFrame, shards: int, column: str):
        self.word, before, self.size = sequence(texts)
        pairs = pair_keys(before, self.word)
        words, at = np.unique(self.word, return_inverse=True)
        by_word = self._spread(words, answers[answers["size"] == 1], shards, column)
        self.c_word = by_word[at]
        by_pair, at_pair = np.unique(pairs, return_inverse=True)
        self.c_pair = self._spread(by_pair, answers[answers["size"] == 2], shards, column)[at_pair]
        # a context occurs as often as its word; the start as often as the end
        self.c_context = np.empty(len(self.word), dtype=np.int64)
        self.c_context[1:] = self.c_word[:-1]
        starts = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.c_context[starts] = self.c_word[np.cumsum(self.size) - 1]

    @staticmethod
    def _spread(keys, answers, shards, column):
        out = np.zeros(len(keys), dtype=np.int64)
        shard = keys % np.uint64(shards)
        for s, data in zip(answers["shard"], answers[column]):
            out[shard == np.uint64(s)] = _unpack(data)
        return out

    def estimates(self, tokens: int, words: int):
        """Bucket of the context's count, and floor, unigram and bigram estimates."""
        bucket = np.where(self.c_context > 0, np.minimum(np.log2(np.maximum(self.c_context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)
        floor = 1.0 / (words + 1)
        return bucket, floor, self.c_word / max(1, tokens), self.c_pair / np.maximum(1, self.c_context)


def fit_weights(stats: pd.DataFrame) -> np.ndarray:
    """Mixture weights ``[bucket, (floor, unigram, bigram)]`` by
    expectation-maximisation on binned ratios of the estimates to the floor
    (columns ``bucket, uni, bi, n``; -1 bins mean a zero estimate). One
    pseudo-count per component keeps all weights positive."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0.5, 0.5, 0.0)  # an unseen context has no bigram estimate
    for b, part in stats.groupby("bucket"):
        ratio = np.stack([np.ones(len(part)), *(np.where(part[c] >= 0, 2.0 ** ((part[c] - 256) / BINS_PER_OCTAVE), 0.0)
                                                for c in ("uni", "bi"))], axis=1)
        n, w = part["n"].to_numpy(dtype=float), weights[int(b)].copy()
        prior = (w > 0).astype(float)
        for _ in range(EM_STEPS):
            mixed = ratio * w
            w = (mixed / mixed.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) + prior
            w /= w.sum()
        weights[int(b)] = w
    return weights


def _bin(ratio: np.ndarray) -> np.ndarray:
    out = np.full(len(ratio), -1, dtype=np.int64)
    some = ratio > 0
    out[some] = np.clip(np.round(np.log2(ratio[some]) * BINS_PER_OCTAVE) + 256, 0, 511).astype(np.int64)
    return out


def score(docs: DataFrame, *, chunk_rows: int = CHUNK_ROWS, shards: int | None = None) -> DataFrame:
    """Score every document; see the module for the model.

    Columns: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score`` (log10; the base is the add-one unigram model).
    Training documents are those whose id's crc32 modulo 7 is not 2. Null
    or empty text: only the end token. Null ids train. Unseen words are one
    class that gets the floor's share. Without training tokens every
    estimate is the floor. Repeated rows all count and score alike. Empty
    table: no rows. Words are told apart by 64-bit hashes. ``docs`` is read
    twice and must give the same rows in the same partitions (files).
    """
    spark = docs.sparkSession
    if shards is None:
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("b")).first()["b"] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunked = _chunked(docs, chunk_rows)
    answers = write_table(_answers(_requests(chunked, shards)), "lm-answers")
    sums = answers.where("chunk = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in
                                             ("tokens", "words", "rest_tokens", "rest_words")]).first()
    n, v = int(sums["tokens"]), int(sums["words"])
    rest_n, rest_v = int(sums["rest_tokens"]), int(sums["rest_words"])
    useful = answers.where("chunk >= 0").select("shard", "size", "chunk", "train", "rest")

    def held_out(key, texts: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame({"bucket": [], "uni": [], "bi": [], "n": []}).astype("int64")
        bucket, floor, uni, bi = _Counts(texts["text"], got, shards, "rest").estimates(rest_n, rest_v)
        rows = pd.DataFrame({"bucket": bucket, "uni": _bin(uni / floor), "bi": _bin(bi / floor)})
        return rows.groupby(["bucket", "uni", "bi"]).size().rename("n").reset_index().astype("int64")

    stats = (chunked.where("em").groupBy("chunk").cogroup(useful.where("chunk % 2 = 1").groupBy("chunk"))
             .applyInPandas(held_out, "bucket bigint, uni bigint, bi bigint, n bigint")
             .groupBy("bucket", "uni", "bi").agg(F.sum("n").alias("n")))
    # at most BUCKETS * 513 * 513 bins, some thousands in practice
    weights = fit_weights(pd.DataFrame([r.asDict() for r in stats.collect()], columns=["bucket", "uni", "bi", "n"]))

    def scored(key, rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        counts = _Counts(rows["text"], got, shards, "train")
        bucket, floor, uni, bi = counts.estimates(n, v)
        w = weights[bucket]
        cuts = np.concatenate([[0], np.cumsum(counts.size)[:-1]])
        mixed = np.log10(w[:, 0] * floor + w[:, 1] * uni + w[:, 2] * bi)
        base = np.log10((counts.c_word + 1) / (n + v + 1))
        return pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "held_out": rows["held"].to_numpy(),
                             "n_tokens": counts.size, "n_known": np.add.reduceat((counts.c_word > 0).astype(np.int64), cuts),
                             "train_tokens": n, "base_score": np.add.reduceat(base, cuts),
                             "score": np.add.reduceat(mixed, cuts)})

    return (chunked.drop("em").groupBy("chunk").cogroup(useful.drop("rest").groupBy("chunk"))
            .applyInPandas(scored, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
                                   "train_tokens bigint, base_score double, score double"))
