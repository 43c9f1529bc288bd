"""Near copies among all documents by edit fingerprints.

Every distinct text gets two fingerprints of ``editprint``, one of the text
and one of the text read backwards: after an edit a walk may stay out of step,
so the part before the edit is written alike forwards and the part after it
backwards. Their ``SIDES`` times ``WIDTH`` places are cut into bands of ``band`` neighbouring bins; texts that agree in
some band (and whose lengths allow it) are candidates. A candidate is
verified over all places of the better side, then by the edit distance of the texts. Exact
copies share one text, so they cost nothing here, and band keys that many
texts share are salted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcast.llm import editprint
from starcast.llm.common import components, write_table
from starcast.operators.joins import hot_keys_by, salted_join

SIDES = 2
BAND = 8
EDIT_SHARE = 0.1
MIN_LIKENESS = 0.15
HOT_ROWS = 10_000


def edit_distance(a: str, b: str, limit: int) -> int | None:
    """Levenshtein distance of code points, or None above ``limit``
    (bit-parallel: a column of the table is one integer)."""
    if abs(len(a) - len(b)) > limit:
        return None
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4") for t in (a, b))
    n = min(len(x), len(y))
    other = np.flatnonzero(x[:n] != y[:n])
    cut = int(other[0]) if len(other) else n
    x, y, n = x[cut:], y[cut:], n - cut
    other = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    cut = int(other[0]) if len(other) else n
    x, y = x[:len(x) - cut], y[:len(y) - cut]
    m, score = len(x), len(x)
    if not m or not len(y):
        return d if (d := max(m, len(y))) <= limit else None
    at = {int(c): int.from_bytes(np.packbits(x == c, bitorder="little").tobytes(), "little") for c in np.unique(x)}
    full, last = (1 << m) - 1, 1 << (m - 1)
    more, less = full, 0
    for left, c in zip(range(len(y) - 1, -1, -1), y.tolist()):
        eq = at.get(c, 0)
        down, across = eq | less, (((eq & more) + more) ^ more) | eq
        up, fall = less | (full & ~(across | more)), more & across
        score += 1 if up & last else -1 if fall & last else 0
        if score - left > limit:
            return None
        up, fall = ((up << 1) | 1) & full, (fall << 1) & full
        more, less = fall | (full & ~(down | up)), up & down
    return score if score <= limit else None


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(F.lit(11), text).alias("node"), text.alias("text"))


def _prints(texts: DataFrame) -> DataFrame:
    def run(batches):
        places = editprint.Places()
        for batch in batches:
            nodes, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lo = 0
            while lo < len(rows):
                hi, size = lo, 0
                while hi < len(rows) and (hi == lo or size + len(rows[hi]) <= editprint.BATCH_CHARS):
                    size += len(rows[hi])
                    hi += 1
                found = np.concatenate([editprint.fingerprints(rows[lo:hi], places),
                                        editprint.fingerprints([t[::-1] for t in rows[lo:hi]], places)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[lo:hi], pa.int64()), pa.array([len(t) for t in rows[lo:hi]], pa.int64()),
                     pa.array([r.tobytes() for r in found], pa.binary())], names=["node", "n", "print"])
                lo = hi

    return texts.select("node", "text").mapInArrow(run, "node bigint, n bigint, print binary")


def _bands(prints: DataFrame, band: int) -> DataFrame:
    """``(band, node, n)``: one key per band that has a place."""
    none = F.lit(bytes([editprint.NONE]) * band)
    parts = F.array(*[F.struct(F.lit(i).alias("i"), F.substring("print", i * band + 1, band).alias("s"))
                      for i in range(SIDES * editprint.WIDTH // band)])
    return (prints.select("node", "n", F.explode(parts).alias("b")).where(F.col("b.s") != none)
            .select(F.xxhash64("b.i", "b.s").alias("band"), "node", "n"))


def _with_side(pairs: DataFrame, side: DataFrame, end: str, hot_rows: int) -> DataFrame:
    """``pairs`` with the columns of ``side(node, ...)`` for node ``end``."""
    hot = write_table(hot_keys_by(pairs, [end], hot_rows)[end], "nc-hot")
    return salted_join(pairs, side.select(*[F.col(c).alias(end if c == "node" else f"{end}_{c}") for c in side.columns]),
                       end, hot, "inner")


def links(docs: DataFrame, *, edit_share: float = EDIT_SHARE, band: int = BAND, min_likeness: float = MIN_LIKENESS,
          hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(u, v, likeness, edits)``, u < v: pairs of distinct texts (64-bit
    hashes) that differ by at most ``edit_share`` times the longer text's
    length in edits. All links found are right; a pair without a common band
    or below ``min_likeness`` is missed, more often the more edits it has.
    Wider bands give fewer candidates and miss more. Texts too short for one
    edit have no links; null texts count as empty."""
    texts = write_table(_texts(docs).groupBy("node").agg(F.first("text").alias("text")), "nc-texts")
    # a partner may be one character longer
    prints = write_table(_prints(texts.where((F.char_length("text") + 1) * edit_share >= 1)), "nc-prints")
    keys = write_table(_bands(prints, band), "nc-bands")
    hot = write_table(hot_keys_by(keys, ["band"], hot_rows)["band"], "nc-hot")
    found = salted_join(keys.withColumnsRenamed({"node": "u", "n": "u_n"}), keys.withColumnsRenamed({"node": "v", "n": "v_n"}),
                        "band", hot, "inner")
    near = F.abs(F.col("u_n") - F.col("v_n")) <= F.floor(F.greatest("u_n", "v_n") * edit_share)
    pairs = write_table(found.where((F.col("u") < F.col("v")) & near).select("u", "v").distinct(), "nc-pairs")

    def alike(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, editprint.WIDTH) for i in (2, 3))
            share = editprint.likeness(a, b).reshape(-1, SIDES).max(axis=1)
            keep = share >= min_likeness
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep)), pa.array(share[keep])],
                names=["u", "v", "likeness"])

    def verified(batches):
        for batch in batches:
            rows = []
            for u, v, share, a, b in zip(*(batch.column(i).to_pylist() for i in range(5))):
                d = edit_distance(a, b, int(max(len(a), len(b)) * edit_share))
                if d is not None:
                    rows.append((u, v, share, d))
            yield pa.RecordBatch.from_pylist([dict(zip(("u", "v", "likeness", "edits"), r)) for r in rows], schema=pa.schema(
                [("u", pa.int64()), ("v", pa.int64()), ("likeness", pa.float64()), ("edits", pa.int64())]))

    side = prints.select("node", "print")
    both = _with_side(_with_side(pairs, side, "u", hot_rows), side, "v", hot_rows)
    kept = write_table(both.select("u", "v", "u_print", "v_print").mapInArrow(alike, "u bigint, v bigint, likeness double"), "nc-alike")
    both = _with_side(_with_side(kept, texts, "u", hot_rows), texts, "v", hot_rows)
    return both.select("u", "v", "likeness", "u_text", "v_text").mapInArrow(
        verified, "u bigint, v bigint, likeness double, edits bigint")


def near_copies(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, node, component_id)`` of every row: its text's hash and the
    least id among the texts that links join up with it (exact copies
    included). Null if none of them has an id. Empty table: no rows."""
    rows = _texts(docs).select("doc_id", "node")
    groups = components(links(docs, **options)).withColumnRenamed("component", "root")
    rooted = write_table(rows.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")), "nc-rooted")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select("doc_id", "node", "component_id")
