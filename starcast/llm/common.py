"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcast.operators.joins import write_table
from starcast.sources.tables import table

# Characters the contracts treat as white space: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["ASCII_SPACE", "UPPER", "ascii_lower", "components", "crc_mod", "row_key", "table", "write_table"]


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


def crc_mod(id_col, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (null ids: -1)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus, F.lit(-1))


def row_key(id_col, text_col):
    """64-bit identity of a (document id, text) row; equal rows share it."""
    return F.xxhash64(F.lit(7), id_col, text_col)


# Edges that one task joins up in memory (about 100 MB of Python objects).
TASK_EDGES = 500_000


def _forest(edges: DataFrame, tasks: int) -> DataFrame:
    """Every task joins up its own edges and returns ``(u, v)`` with v the
    least node it can reach from u: at most one edge per node and task."""
    import pyarrow as pa

    def run(batches):
        root: dict[int, int] = {}

        def find(x):
            top = x
            while root[top] != top:
                top = root[top]
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root.setdefault(a, a)
                root.setdefault(b, b)
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
        nodes = [x for x in root if root[x] != x]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())],
                                         names=["u", "v"])

    return edges.coalesce(tasks).mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60,
               task_edges: int = TASK_EDGES) -> DataFrame:
    """Connected components of an undirected edge table of long ids.

    Tasks of at most about ``task_edges`` edges join up their own edges.
    While that takes more than one task, a round of large-star / small-star
    points each node at the smallest neighbour it knows, until the edges
    form stars. A half round is a partial aggregation and a shuffle join
    against a written table, so a hub's rows can be split by the skew-join
    rule; lineage is cut by tables in the shared folder. Returns
    ``(node, component)`` for every node with an edge to another node;
    ``component`` is the smallest node reachable. Self-loops and null ends
    are ignored; an empty edge table gives an empty result.
    """
    cur = write_table(edges.where(F.col(u) != F.col(v))
                      .select(F.greatest(u, v).cast("bigint").alias("u"), F.least(u, v).cast("bigint").alias("v")), "cc-edges")
    mark = None
    for _ in range(max_rounds):
        count = cur.count()
        tasks = max(1, -(-count // task_edges))
        cur = write_table(_forest(cur, tasks), "cc-forest")
        if tasks == 1:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = write_table(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "cc-min")
        large = write_table(both.where(F.col("v") > F.col("u")).join(least, "u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")), "cc-large")
        least = write_table(large.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        small = (large.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        cur = write_table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        before, mark = mark, _mark(cur)
        if before == mark:
            break
    else:
        raise RuntimeError("components did not converge")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
