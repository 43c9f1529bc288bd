"""Toxicity scores by non-negative positive-unlabelled learning.

Training uses confirmed toxic documents and unlabelled text only (plus the
toxic share among labelled rows as class prior). The risk estimator takes
the prior-corrected loss of the unlabelled part as the negative class's
loss; when a batch drives that part below zero, the step ascends it
instead, so the classifier cannot memorize the positives. The classifier
is linear over the presence of words and their prefixes (hashed). Only
those significantly more frequent in the positives than in the whole corpus
have weights, so a long text's many neutral words add no noise; document
frequencies are counted over every usable document. The weights are fitted in
numpy on a bounded sample; every whole text is scored on the executors.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcast.llm.common import crc_mod, write_table

BUCKETS = 1 << 18
# Documented bounds of the training sample (documents, by id hash).
MAX_POSITIVE = 4000
MAX_UNLABELLED = 8000
MIN_DOCS = 4
MIN_Z = 4.0  # two-proportion z score of a bucket's share of the positives over that of the corpus
CACHE_WORDS = 500_000  # words whose buckets a task remembers
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.3
FOLDS, HELD_FOLD = 4, 2
_WORD = re.compile(r"[^\W\d_]+")


def buckets(word: str) -> list[int]:
    """Hash buckets of a word and of its prefixes."""
    parts = [word, *(word[:n] + "-" for n in PREFIXES if len(word) >= n)]
    return [zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts]


def words(text: str) -> set[str]:
    """Distinct words (letter runs, lower case)."""
    return set(_WORD.findall(text.lower()))


def features(text: str) -> np.ndarray:
    """Distinct buckets of a text's words, sorted."""
    return np.array(sorted({b for w in words(text) for b in buckets(w)}), dtype=np.int32)


def _sample_features(rows: DataFrame) -> list[np.ndarray]:
    def run(batches):
        for batch in batches:
            feats = [features(t or "").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(feats, pa.binary())], names=["f"])

    return [np.frombuffer(r["f"], dtype=np.int32) for r in rows.select("text").mapInArrow(run, "f binary").collect()]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """``(rows, documents per bucket)`` over every row of ``docs(text)``.

    A task adds up its own rows in one array and sends a row per bucket it
    met, so what is shuffled and what reaches the driver (at most ``BUCKETS``
    rows) does not depend on the texts' lengths. Null texts have no words;
    repeated rows count each; an empty table gives zeros."""
    def run(batches):
        rows, seen, cache = 0, np.zeros(BUCKETS, np.int64), {}
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0).to_pylist():
                found: set[int] = set()
                for word in words(text) if text else ():
                    got = cache.get(word)
                    if got is None:
                        if len(cache) >= CACHE_WORDS:
                            cache.clear()
                        got = cache[word] = buckets(word)
                    found.update(got)
                seen[np.fromiter(found, np.int64, len(found))] += 1
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1).astype(np.int32)), pa.array(np.append(seen[met], rows))],
                                         names=["bucket", "n"])

    sums = (docs.select(F.col("text").cast("string")).mapInArrow(run, "bucket int, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    at, n = sums.column("bucket").to_numpy(), sums.column("n").to_numpy()
    counts = np.zeros(BUCKETS, np.int64)
    counts[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), counts


def _csr(feats: list[np.ndarray]):
    ptr = np.concatenate([[0], np.cumsum([len(f) for f in feats])]).astype(np.int64)
    return ptr, (np.concatenate(feats) if feats else np.zeros(0, np.int32))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def screened(in_positives: np.ndarray, positives: int, in_corpus: np.ndarray, documents: int, min_docs: int = MIN_DOCS,
             min_z: float = MIN_Z) -> np.ndarray:
    """Buckets in at least ``min_docs`` documents whose share of the positives
    exceeds that of the corpus by ``min_z`` standard errors."""
    both = in_positives + in_corpus
    share = both / (positives + documents)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / positives + 1 / documents))
    return np.flatnonzero((both >= min_docs) & (in_positives / positives - in_corpus / documents > min_z * error))


def risk_gradient(positive: np.ndarray, unlabelled: np.ndarray, prior: float, beta: float = 0.0):
    """``(negative part, d/d positive, d/d unlabelled)`` for a batch's scores.

    The derivatives are those of the PU risk ``prior * E_p[l(g)] + negative
    part`` under the logistic loss; where the negative part ``E_u[l(-g)] -
    prior * E_p[l(-g)]`` is below ``-beta``, those of minus that part."""
    sp, su = _sigmoid(positive), _sigmoid(unlabelled)
    # l(g) = log(1 + exp(-g)): l'(g) = s - 1, and l(-g)' = s
    negative = np.logaddexp(0, unlabelled).mean() - prior * np.logaddexp(0, positive).mean()
    gp, gu = -prior * sp / len(sp), su / len(su)
    if negative < -beta:
        return negative, -gp, -gu
    return negative, gp + prior * (sp - 1) / len(sp), gu


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, corpus: tuple[int, np.ndarray] | None = None, *,
             epochs: int = 40,
             batches: int = 12, rate: float = 0.02, decay: float = 1e-3, beta: float = 0.0, averaged: int = 10, seed: int = 5):
    """Weights and bias of a linear classifier with minimal non-negative PU
    risk ``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])`` under
    the logistic loss, by Adam over shuffled batches that hold the same
    fraction of both parts; the last ``averaged`` epochs' weights are averaged.
    Buckets that ``screened`` leaves out have no weight; ``corpus`` is
    ``document_frequencies`` of the corpus (else those of ``unlabelled``)."""
    pp, pi = _csr(positive)
    up, ui = _csr(unlabelled)
    documents, in_corpus = corpus or (len(unlabelled), np.bincount(ui, minlength=BUCKETS))
    used = screened(np.bincount(pi, minlength=BUCKETS), len(positive), in_corpus, documents)
    column = np.full(BUCKETS, -1, np.int64)
    column[used] = np.arange(len(used))
    w, b = np.zeros(len(used)), np.log(prior / (1 - prior))
    m, v, mb, vb, step = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0, 0
    rng = np.random.default_rng(seed)

    def rows(ptr, idx, pick):
        size = ptr[pick + 1] - ptr[pick]
        at = np.repeat(ptr[pick] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        col, row = column[idx[at]], np.repeat(np.arange(len(pick)), size)
        keep = col >= 0
        return col[keep], row[keep], len(pick)

    def score(part):
        return b + np.bincount(part[1], weights=w[part[0]], minlength=part[2])

    mean_w, mean_b = np.zeros_like(w), 0.0
    for epoch in range(epochs):
        order_p = np.array_split(rng.permutation(len(positive)), batches)
        order_u = np.array_split(rng.permutation(len(unlabelled)), batches)
        for a, c in zip(order_p, order_u):
            if not len(a) or not len(c):
                continue
            p, u = rows(pp, pi, a), rows(up, ui, c)
            _, gp, gu = risk_gradient(score(p), score(u), prior, beta)
            grad = (np.bincount(p[0], weights=gp[p[1]], minlength=len(w))
                    + np.bincount(u[0], weights=gu[u[1]], minlength=len(w)) + decay * w)
            gb = gp.sum() + gu.sum()
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
            w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
            b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
        if epoch >= epochs - averaged:
            mean_w += w / min(averaged, epochs)
            mean_b += b / min(averaged, epochs)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = mean_w
    return weights, float(mean_b)


def train(docs: DataFrame, labels: DataFrame, *, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED):
    """Fit on documents outside the held-out fold (crc32 of the id modulo
    ``FOLDS`` is ``HELD_FOLD``).

    Positives are rows labelled toxic, unlabelled are all other rows (a row's
    label 0 is not used but for the prior). Both samples are bounded and
    drawn by id hash; only ids are shuffled, the texts of the drawn ids are
    found by a broadcast of those ids. In them, rows that repeat an id count
    once, with the least text. Document frequencies are those of all usable
    rows. Without positives or unlabelled rows the model is constant at the
    prior."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("_id").agg(F.max("toxic").alias("toxic")))
    usable = docs.select("doc_id", "text").where(
        F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_FOLD))
    ids = write_table(usable.select("doc_id").distinct().join(known, F.col("doc_id") == F.col("_id"), "left")
                      .select("doc_id", "toxic"), "tox-ids")
    shares = ids.agg(F.count(F.lit(1)).alias("rows"), F.count("toxic").alias("n"),
                     F.count(F.when(F.col("toxic") == 1, 1)).alias("p")).first()
    n, p = shares["n"], shares["p"]
    prior = min(0.9, max(1e-3, p / n)) if n else 1e-3
    others = shares["rows"] - p
    order = F.xxhash64(F.lit(3), F.col("doc_id"))

    def bounded(rows, size, limit):
        if size > limit:  # a hash threshold keeps about ``limit`` rows without a global sort
            bound = int((2 ** 64 - 1) * (limit / size)) - 2 ** 63
            rows = rows.where(order <= F.lit(bound))
        drawn = usable.join(F.broadcast(rows.select("doc_id")), "doc_id", "left_semi")
        return _sample_features(drawn.groupBy("doc_id").agg(F.min("text").alias("text")))

    positive = bounded(ids.where("toxic = 1"), p, max_positive)
    unlabelled = bounded(ids.where("toxic is null or toxic <> 1"), others, max_unlabelled)
    if not positive or not unlabelled:
        return np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior)))
    # the positives were taken out of the unlabelled part; put their share back
    add = max(1, round(len(unlabelled) * p / max(1, others)))
    unlabelled = unlabelled + positive[:min(add, len(positive))]
    return fit_nnpu(positive, unlabelled, prior, document_frequencies(usable))


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) added, replacing a column so named.

    Whole texts count, by their distinct words. Null and empty texts get the
    score of a text without words. Repeated rows get equal scores; an empty
    table gives no rows."""
    weights, bias = model
    weight = {int(b): float(weights[b]) for b in np.flatnonzero(weights)}

    def run(series):
        cache: dict[str, tuple[int, ...]] = {}
        for texts in series:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                found: set[int] = set()
                for word in words(text) if text else ():
                    got = cache.get(word)
                    if got is None:
                        if len(cache) >= CACHE_WORDS:
                            cache.clear()
                        got = cache[word] = tuple(b for b in buckets(word) if b in weight)
                    found.update(got)
                out[i] = bias + sum(weight[b] for b in sorted(found))
            yield _series(_sigmoid(out))

    return docs.drop("score").withColumn("score", _scorer(run)(F.col("text").cast("string")))


def _series(values):
    import pandas as pd

    return pd.Series(values)


def _scorer(run):
    from collections.abc import Iterator

    import pandas as pd

    def f(series):
        return run(series)

    f.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(f, "double")
