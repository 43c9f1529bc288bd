"""Stable sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table
(offset and skip from two hashes of its name). Shards take turns claiming
their next free slot until the table is full, so shares differ by at most
one slot and a changed shard list moves few slots. A document's slot is
its id's hash modulo the prime; the table (one row per slot, a fixed
size) is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65537  # prime


def _hash(name: str, salt: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{salt}:{name}".encode())


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index in ``shards``. ``size`` must be a prime of at least the
    number of shards; names must be distinct. The order of the names does
    not matter beyond the returned indexes."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and not empty")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("size must be a prime of at least the number of shards")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    at = {i: _hash(shards[i], "offset") % size for i in turns}
    skip = {i: _hash(shards[i], "skip") % (size - 1) + 1 for i in turns}
    owner = [-1] * size
    filled = 0
    while filled < size:
        for i in turns:
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            owner[at[i]] = i
            filled += 1
            if filled == size:
                break
    return owner


def place(docs: DataFrame, shards: list[str], *, size: int = TABLE_SIZE, key: str = "doc_id") -> DataFrame:
    """Add ``slot`` and ``shard`` to the rows of ``docs`` (replacing columns
    of these names).

    Equal keys share a shard, so repeated rows stay together. A row with a
    null key is placed by a hash of its ``text`` (or slot of the null hash
    when there is none), so null keys do not pile up on one shard. Empty
    table: no rows.
    """
    spark: SparkSession = docs.sparkSession
    owner = lookup_table(shards, size)
    slots = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(owner)], "slot int, shard string")
    docs = docs.drop("slot", "shard")
    fallback = F.xxhash64(F.lit(1), F.col("text")) if "text" in docs.columns else F.lit(42)
    hashed = F.when(F.col(key).isNull(), fallback).otherwise(F.xxhash64(F.col(key)))
    return (docs.withColumn("slot", F.pmod(hashed, F.lit(size)).cast("int"))
            .join(F.broadcast(slots), "slot").select(*docs.columns, "slot", "shard"))


def write_sharded(docs: DataFrame, path: str, shards: list[str], *, size: int = TABLE_SIZE) -> None:
    """Write ``docs`` as Parquet, one folder per shard. Rows are dealt to
    tasks by slot, so a shard is written by many tasks, not one."""
    placed = place(docs, shards, size=size)
    placed.repartition("slot").write.mode("overwrite").partitionBy("shard").parquet(path)
