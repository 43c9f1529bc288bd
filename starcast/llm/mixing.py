"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output over its
share of the input. Each document's count is the quantile of the Poisson
distribution with that mean at a uniform number hashed from the document
and a seed, so the mix is repeatable and needs no coordination. Documents
are exploded by their counts and sorted by a hash, a global shuffle that
does not depend on input order.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcast.llm.common import write_table

ALPHA = 0.5
SEED = 17
HEAVY_RATE = 64  # copies of a document that one task writes in a row
BROADCAST_SOURCES = 100_000


def poisson_quantile(u: np.ndarray, mean: float) -> np.ndarray:
    """Smallest k with P(X <= k) > u for X ~ Poisson(mean). The cumulative
    sums run over a window of 12 standard deviations and 40 values around
    the mean, beyond which the mass is below double precision."""
    if not mean > 0:
        return np.zeros(len(u), dtype=np.int64)
    half = 12 * math.sqrt(mean) + 40
    low = max(0, int(mean - half))
    k = np.arange(low, int(mean + half) + 2, dtype=np.float64)
    first = low * math.log(mean) - mean - math.lgamma(low + 1)
    logs = first + np.concatenate([[0.0], np.cumsum(math.log(mean) - np.log(k[1:]))])
    return low + np.searchsorted(np.cumsum(np.exp(logs)), u, side="right").clip(max=len(k) - 1)


def target_rates(docs: DataFrame, weights: dict | None = None, *, alpha: float = ALPHA,
                 total: int | None = None) -> DataFrame:
    """``(source, n, rate)``: mean copies per document of every source.

    ``weights`` maps source names to target shares (sources not named get
    none); without it the share is ``n ** alpha``, which evens out sources
    for ``alpha < 1``. ``total`` is the expected output size (default: the
    input's). Null sources form one source of their own."""
    counts = write_table(docs.groupBy(F.col("source").cast("string").alias("source"))
                         .agg(F.count(F.lit(1)).alias("n")), "mix-sources")
    if weights is None:
        weighted = counts.withColumn("w", F.pow("n", F.lit(float(alpha))))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()],
                                                  "name string, w double")
        weighted = (counts.join(named, F.col("source").eqNullSafe(F.col("name")), "left")
                    .select("source", "n", F.coalesce("w", F.lit(0.0)).alias("w")))
    sums = weighted.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    size = total if total is not None else (sums["n"] or 0)
    scale = size / sums["w"] if sums["w"] else 0.0
    return weighted.select("source", "n", (F.lit(float(scale)) * F.col("w") / F.col("n")).alias("rate"))


def mix(docs: DataFrame, weights: dict | None = None, *, alpha: float = ALPHA, total: int | None = None,
        seed: int = SEED) -> DataFrame:
    """``docs`` replicated to the target weights and globally shuffled, with
    ``replica`` (from 1) and ``shuffle_key`` in place of columns so named.

    The rates join is broadcast while there are at most
    ``BROADCAST_SOURCES`` sources (counted), else a shuffle join whose hot
    sources the skew-join rule splits. The shuffle key is a uniform hash, so
    its ranges are known beforehand: rows go to them without a sampling pass,
    and counts are drawn once. Documents of sources with a rate above
    ``HEAVY_RATE`` are dealt out in parts of as many copies first. Equal rows
    get equal counts; null ids are told apart by their text. Null text
    counts as a document. Empty table: no rows.
    """
    rates = write_table(target_rates(docs, weights, alpha=alpha, total=total), "mix-rates")
    row = rates.agg(F.count(F.lit(1)).alias("n"), F.max("rate").alias("top")).first()
    heavy = (row["top"] or 0) > HEAVY_RATE
    held = rates.select(F.col("source").alias("name"), "rate")
    if row["n"] <= BROADCAST_SOURCES:
        held = F.broadcast(held)
    docs = docs.drop("replica", "shuffle_key")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the documents as one struct, so that no name of theirs can clash
    rows = (docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("i"), F.col("text").alias("t"),
                        F.col("source").cast("string").alias("s"))
            .join(held, F.col("s").eqNullSafe(F.col("name"))))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "i", "t"), 11) / F.lit(float(1 << 53))

    @F.pandas_udf("bigint")
    def copies(u: pd.Series, rate: pd.Series) -> pd.Series:
        out = np.zeros(len(u), dtype=np.int64)
        for mean in rate.unique():
            at = (rate == mean).to_numpy()
            out[at] = poisson_quantile(u.to_numpy()[at], float(mean))
        return pd.Series(out)

    counted = rows.select("doc", "i", "t", copies(u, F.col("rate")).alias("n")).where("n > 0")
    if heavy:
        counted = (counted.select("doc", "i", "t", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(HEAVY_RATE))).alias("base"))
                   .repartition(parts, F.xxhash64("i", "t", "base")))
        step = F.least(F.col("n") - F.col("base"), F.lit(HEAVY_RATE))
        replica = F.explode(F.sequence(F.col("base") + 1, F.col("base") + step))
    else:
        replica = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))
    copied = counted.select("doc", "i", "t", replica.alias("replica")).withColumn("replica", F.col("replica").cast("int"))
    keyed = copied.select("doc", "i", "replica", F.xxhash64(F.lit(seed + 1), "i", "t", "replica").alias("shuffle_key"))
    # equal ranges of the signed key, in order
    part = F.floor((F.col("shuffle_key") / F.lit(2.0 ** 64) + 0.5) * parts).cast("int")
    ranged = keyed.repartitionById(parts, F.least(part, F.lit(parts - 1))).sortWithinPartitions("shuffle_key", "i", "replica")
    return ranged.select("doc.*", "replica", "shuffle_key")
