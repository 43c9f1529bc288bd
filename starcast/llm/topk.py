"""Exact top-k inner products by block-at-a-time pruning.

Vectors are quantised to integers, ordered by a coarse cluster so that
neighbours share ranges, and cut into blocks of consecutive rows. A block
keeps its forward index (the integer rows) and, per term (dimension), its
maximum and minimum. A query's score in a block is at most the sum over
terms of the larger of query times maximum and query times minimum. Each
task orders its blocks by that bound per query and scores them until the
bound falls below the query's k-th best score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starcast.llm.common import write_table

SCALE = 256
K = 5
EVERY = 50
BLOCK = 128
CLUSTERS = 64
SAMPLE = 4096
QUERY_BLOCK = 2048
LOWEST = -(2 ** 62)


def quantise(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: floor(256 * x) of every component, for vectors without
    null or non-finite components; null ids are left out too."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select("vec_id", doubles.alias("d")).where("d is not null and vec_id is not null").where(fine)
            .select("vec_id", F.transform("d", lambda x: F.floor(x * SCALE).cast("bigint")).alias("v")))


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _centroids(sample: np.ndarray, clusters: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = sample.astype(float)
    c = x[rng.choice(len(x), size=min(clusters, len(x)), replace=False)]
    for _ in range(rounds):
        at = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        for j in range(len(c)):
            if (at == j).any():
                c[j] = x[at == j].mean(axis=0)
    return c


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in exact integers: in doubles while every sum fits 2^53."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2 ** 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def _bounds(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    return _product(np.maximum(q, 0), top) + _product(np.minimum(q, 0), low)


def _merge(scores, ids, new_scores, new_ids, k):
    """The k best of both by score, ties to the smaller id."""
    s = np.concatenate([scores, new_scores], axis=1)
    i = np.concatenate([ids, np.broadcast_to(new_ids, new_scores.shape)], axis=1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def build_index(vectors: DataFrame, *, block: int = BLOCK, clusters: int = CLUSTERS,
                sample: int = SAMPLE) -> tuple[DataFrame, np.ndarray, np.ndarray, int]:
    """``(blocks, sample ids, sample rows, width)``.

    ``vectors`` is ``quantise``'s table, written. The clusters that order
    the rows are fitted on the ``sample`` rows of least id hash; every row
    is indexed. Cluster and id together make the ranges, so one cluster's
    rows may span any number of partitions."""
    width = vectors.agg(F.max(F.size("v")).alias("w")).first()["w"] or 0
    some = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    rows = _matrix([r["v"] for r in some], width)
    ids = np.array([r["vec_id"] for r in some], dtype=np.int64)
    if not len(some) or not width:
        centres = np.zeros((1, max(width, 1)))
    else:
        centres = _centroids(rows, clusters)
    half = 0.5 * (centres * centres).sum(axis=1)

    @F.pandas_udf("int")
    def cluster(v):
        import pandas as pd

        m = _matrix(list(v), max(width, 1))
        return pd.Series((m @ centres.T - half).argmax(axis=1).astype(np.int32))

    def cut(batches):
        held_ids: list = []
        held: list = []

        def send(n):
            m = _matrix(held[:n], width)
            i = np.array(held_ids[:n], dtype="<i8")
            del held[:n], held_ids[:n]
            return pa.RecordBatch.from_arrays(
                [pa.array([x.astype("<i8").tobytes()]) for x in (i, m, m.max(axis=0), m.min(axis=0))],
                names=["ids", "rows", "top", "low"])

        for batch in batches:
            held_ids += batch.column(0).to_pylist()
            held += batch.column(1).to_pylist()
            while len(held) >= block:
                yield send(block)
        if held:
            yield send(len(held))

    ordered = (vectors.withColumn("cluster", cluster("v")).repartitionByRange("cluster", "vec_id")
               .sortWithinPartitions("cluster", "vec_id").select("vec_id", "v"))
    blocks = ordered.mapInArrow(cut, "ids binary, rows binary, top binary, low binary")
    return write_table(blocks, "topk-blocks"), ids, rows, width


def _search(blocks: DataFrame, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, width: int,
            k: int) -> DataFrame:
    """The k best of every task's blocks for one bounded block of queries.
    ``floor`` is a proven lower bound of each query's k-th best score."""
    def run(batches):
        best_s = np.full((len(queries), k), LOWEST, dtype=np.int64)
        best_i = np.zeros((len(queries), k), dtype=np.int64)
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(4)]
            top, low = (np.stack([np.frombuffer(x, "<i8") for x in c]) for c in cols[2:])
            bound = _bounds(queries, top, low)
            order = np.argsort(-bound, axis=1, kind="stable")
            active = np.arange(len(queries))
            for place in range(len(top)):
                at = order[active, place]
                alive = bound[active, at] >= np.maximum(floor[active], best_s[active, -1])
                active, at = active[alive], at[alive]  # later blocks of a dropped query are bounded lower still
                if not len(active):
                    break
                for b in np.unique(at):
                    who = active[at == b]
                    ids = np.frombuffer(cols[0][b], "<i8")
                    scores = _product(queries[who], np.frombuffer(cols[1][b], "<i8").reshape(len(ids), width))
                    scores[query_ids[who][:, None] == ids[None, :]] = LOWEST
                    best_s[who], best_i[who] = _merge(best_s[who], best_i[who], scores, ids, k)
        q, r = np.nonzero(best_s > LOWEST)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(query_ids[q]), pa.array(best_i[q, r]),
                                          pa.array(best_s[q, r])], names=["q", "query_id", "vec_id", "score"])

    return blocks.mapInArrow(run, "q int, query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, *, k: int = K, every: int = EVERY, query_block: int = QUERY_BLOCK,
          block: int = BLOCK, clusters: int = CLUSTERS, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of
    ``vectors(vec_id, embedding)`` whose id is divisible by ``every`` the
    ``k`` best other rows by integer inner product, ties to the smaller id.

    Rows with a null id or vector, or with null or non-finite components,
    take no part. Shorter vectors count as padded with zeros. Repeated ids:
    equal rows ask once, a query never meets rows of its own id, other
    repeated rows are candidates each. Fewer candidates than ``k``: all.
    Empty table: no rows. Queries go in blocks of about ``query_block``
    rows (dealt by id hash), one pass over the index each, so what is
    broadcast is bounded.
    """
    spark = vectors.sparkSession
    rows = write_table(quantise(vectors), "topk-vectors")
    blocks, ids, seen, width = build_index(rows, block=block, clusters=clusters, sample=sample)
    asked = write_table(rows.where(F.col("vec_id") % every == 0).distinct(), "topk-queries")
    count = asked.count()
    results = None
    groups = -(-count // query_block) if width else 0
    for g in range(groups):
        got = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).collect()
        if not got:
            continue
        query_ids = np.array([r["vec_id"] for r in got], dtype=np.int64)
        queries = _matrix([r["v"] for r in got], width)
        floor = _product(queries, seen)
        floor[query_ids[:, None] == ids[None, :]] = LOWEST
        floor = np.sort(floor, axis=1)[:, -k] if len(ids) >= k else np.full(len(got), LOWEST)
        part = _search(blocks, query_ids, queries, floor, width, k)
        # the same id may ask with different vectors: q tells them apart
        w = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
        ranked = (part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                  .select("query_id", "rank", "vec_id", "score"))
        if groups > 1:
            ranked = write_table(ranked, "topk-ranked")
        results = ranked if results is None else results.unionByName(ranked)
    if results is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return results
