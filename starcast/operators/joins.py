"""Fact-to-dimension joins that hold up under skew.

The feature joins attach one row per key (a business or a user) to many
rating rows. The plan is picked by a checked size:

1. The dimension was materialized and measured (``materialize``: exact
   payload bytes from one aggregate) and fits ``broadcast_bytes``:
   broadcast it. The fact
   side is not shuffled at all, so a key holding a third of the rows costs
   nothing extra.
2. A hot-key table is supplied (``hot_keys_by`` over a materialized fact):
   a shuffle join in which each hot key's fact rows are spread over
   ``ceil(count / hot_rows)`` salts by a hash of the row's other columns,
   and its single dimension row is replicated once per salt. At most
   ``fact rows / hot_rows`` keys can be hot, which bounds the broadcast
   hot-key table.
3. Otherwise a plain shuffle join: AQE turns it into a broadcast join
   when the dimension's measured shuffle output is under
   ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a runtime size
   check), and otherwise splits oversized fact partitions (skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_HOT_ROWS = 1_000_000
HOT_BUCKETS = 1 << 14
NULL_SALTS = 1024  # rows without a key match nothing, so any salt will do


_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
ROW_OVERHEAD = 16


def _payload(field: T.StructField):
    """Aggregate giving a column's total bytes, or None if not measurable."""
    c, t = F.col(field.name), field.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) + F.count(F.lit(1)) * 8
    if isinstance(t, _FIXED):
        return F.count(F.lit(1)) * 8
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, _FIXED):
        return F.coalesce(F.sum(F.size(c)), F.lit(0)) * 8 + F.count(F.lit(1)) * 16
    return None


# Settings of Parquet for rows of some 100 KB each. A reader takes up to 4,096
# rows of a row group at once, whatever they hold.
LARGE_ROWS = {"parquet.block.size": str(8 * 2 ** 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "8"}


def write_table(df: DataFrame, name: str = "table", large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read
    it back: the plan runs once, later reads do not recompute the inputs,
    and a lost executor costs a re-read, not a recomputation. (A
    ``Dataset.checkpoint`` would run the plan twice unless cached.)"""
    from starcast.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize(df: DataFrame, name: str = "table") -> tuple[DataFrame, int, int | None]:
    """Write the table to the shared folder (``write_table``), then count
    the rows and measure the payload bytes in one aggregate over the
    written data: ``(df, rows, bytes)``. ``bytes`` is None when a column
    type (vector, map, struct) cannot be measured; callers bound it instead.
    """
    done = write_table(df, name)
    parts = [_payload(f) for f in done.schema.fields]
    aggs = [F.count(F.lit(1)).alias("rows")]
    if all(p is not None for p in parts):
        total = F.count(F.lit(1)) * ROW_OVERHEAD
        for p in parts:
            total = total + p
        aggs.append(total.alias("bytes"))
    row = done.agg(*aggs).first()
    return done, int(row["rows"]), (int(row["bytes"]) if "bytes" in row.asDict() else None)


def materialize_all(tables: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, int, int | None]]:
    """``materialize`` several independent tables as concurrent jobs, so
    they share free task slots instead of running back to back."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        futures = {k: pool.submit(materialize, df, k) for k, df in tables.items()}
        return {k: f.result() for k, f in futures.items()}


def write_bucketed(df: DataFrame, key: str, name: str = "bucketed") -> DataFrame:
    """Write ``df`` under the shared folder bucketed and sorted by ``key``, in as
    many buckets as there are shuffle partitions, and read it back. A join
    on the key then shuffles only the other side, and every job that joins
    the table shares this one layout."""
    from starcast.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rsplit("/", 1)[1].replace("-", "_")
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def co_located(df: DataFrame, key: str, dim_bytes: int | None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               name: str = "bucketed") -> DataFrame:
    """A written dimension as it is where it is broadcast, else bucketed by its key."""
    return df if fits_broadcast(dim_bytes, broadcast_bytes) else write_bucketed(df, key, name)


def fits_broadcast(dim_bytes: int | None, broadcast_bytes: int) -> bool:
    return dim_bytes is not None and dim_bytes <= broadcast_bytes


def hot_keys_by(fact: DataFrame, keys: list[str], hot_rows: int = DEFAULT_HOT_ROWS) -> dict[str, DataFrame]:
    """Hot keys of several single-column keys in one aggregation pass.

    ``groupingSets`` counts every key column in one Expand + partial
    aggregate + shuffle; each returned table ``(key, _salts)`` has at most
    ``fact rows / hot_rows`` rows. Meant for a materialized fact.
    """
    sets = [[k] for k in keys]
    counts = (fact.groupingSets(sets, *keys)
              .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_g"))
              .where(F.col("_n") > hot_rows))
    out = {}
    n = len(keys)
    for i, k in enumerate(keys):
        gid = sum(1 << (n - 1 - j) for j in range(n) if j != i)  # all but k aggregated away
        out[k] = (counts.where(F.col("_g") == gid)
                  .select(k, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts")))
    return out


def rare_hot_keys(fact: DataFrame, keys: list[str], hot_rows: int = DEFAULT_HOT_ROWS,
                  buckets: int = HOT_BUCKETS) -> dict[str, DataFrame]:
    """``hot_keys_by`` for keys of which few or none are hot; a key column
    without any has no table.

    Rows are counted by a hash bucket of each key first, which combines before
    the shuffle however many keys there are. Only keys in buckets of more than
    ``hot_rows`` rows can be hot, and only those are counted one by one.
    """
    place = {k: F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int") for k in keys}
    each = F.inline(F.array(*[F.struct(F.lit(k).alias("_k"), place[k].alias("_b")) for k in keys]))
    full = (fact.select(each).groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
            .select("_k", "_b").collect())  # at most len(keys) x min(buckets, rows / hot_rows)
    out = {}
    for k in keys:
        heavy = [r["_b"] for r in full if r["_k"] == k]
        if heavy:
            out[k] = hot_keys_by(fact.where(place[k].isin(heavy)), [k], hot_rows)[k]
    return out


def salted_join(fact: DataFrame, dim: DataFrame, key: str, hot: DataFrame, how: str = "left") -> DataFrame:
    """Shuffle join on ``(key, salt)``: hot keys' fact rows are spread over
    their salts, their dimension rows replicated per salt. Rows with a null
    key are spread too."""
    hot = F.broadcast(hot)
    others = [c for c in fact.columns if c != key]
    spread = F.xxhash64(*[F.col(c) for c in others]) if others else F.lit(0)
    fact_s = (fact.join(hot, key, "left")
              .withColumn("_salt", F.when(F.col(key).isNull(), F.pmod(spread, F.lit(NULL_SALTS)).cast("int"))
                          .when(F.col("_salts").isNull(), F.lit(0))
                          .otherwise(F.pmod(spread, F.col("_salts")).cast("int")))
              .drop("_salts"))
    dim_s = (dim.join(hot, key, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
             .drop("_salts"))
    return fact_s.join(dim_s, [key, "_salt"], how).drop("_salt")


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, how: str = "left", *,
                   dim_bytes: int | None = None,
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                   hot: DataFrame | None = None) -> DataFrame:
    """``fact ⟕ dim`` on ``key`` (see module doc for the three plans);
    ``dim_bytes`` is a proven upper bound of the dimension's size."""
    if fits_broadcast(dim_bytes, broadcast_bytes):
        return fact.join(F.broadcast(dim), key, how)
    if hot is not None:
        return salted_join(fact, dim, key, hot, how)
    return fact.join(dim, key, how)


def with_hot_keys(pairs: DataFrame, hot_rows: int | None = DEFAULT_HOT_ROWS, dim_bytes: list[int | None] = (),
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, written: bool = False):
    """``(pairs, hot-key tables by key)``, only when some dimension will be
    shuffle-joined: with every dimension broadcast the pairs never shuffle
    for the joins and are not written out, nor where they are ``written``."""
    if not hot_rows or all(fits_broadcast(b, broadcast_bytes) for b in dim_bytes):
        return pairs, None
    if not written:
        pairs = write_table(pairs, "pairs")  # read twice: key counts and the join
    return pairs, rare_hot_keys(pairs, ["business_id", "user_id"], hot_rows)
