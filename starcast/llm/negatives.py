"""Hard negatives by exact inner products on Kronecker-packed integers.

Candidates' components are made non-negative by a bias and several
candidates share one wide integer, each in a field that holds the largest
sum it can get. One multiplication per anchor component then serves all
fields at once; the sums are unpacked and freed of the biases. Where two
fields and more fit the 53 exact bits of a double, the products run as a
matrix product of doubles, otherwise on Python's integers of any width.

Anchors and candidates are cut into cells of bounded size by label and id
hash. Every cell of anchors meets every cell of candidates it needs in one
task: those of its label bucket for positives, all for negatives. What a
task returns is at most the asked ranks per anchor.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starcast.llm.common import write_table

EVERY = 100
SCALE = 256
MOVED = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
BUCKETS = 64
CELL_BYTES = 16 * 2 ** 20
SLICE_SCORES = 2 ** 21
WIDE_FIELDS = 64
EXACT_BITS = 53


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, v)`` of rows with an id, a label and a whole finite
    vector: components as floor(256 * x), the label of every seventh id
    moved on by one."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label)
    fine = F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select("vec_id", moved.alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("d"))
            .where("vec_id is not null and label is not null and d is not null").where(fine)
            .select("vec_id", "label", F.transform("d", lambda x: F.floor(x * SCALE).cast("bigint")).alias("v")))


class Packed:
    """Candidate rows packed for exact products with anchor rows."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, exact_bits: int = EXACT_BITS):
        self.count, width = rows.shape
        low, top = (int(min(0, rows.min())), int(rows.max())) if rows.size else (0, 0)
        a_low, a_top = (int(min(0, anchors.min())), int(anchors.max())) if anchors.size else (0, 0)
        self.bias, self.anchor_bias, self.width = -low, -a_low, width
        largest = max(1, width) * max(1, top - low) * max(1, a_top - a_low)
        self.bits = largest.bit_length()
        doubles = exact_bits // self.bits
        self.doubles = doubles >= 2
        self.fields = doubles if self.doubles else WIDE_FIELDS
        kind = np.float64 if self.doubles else object
        groups = -(-self.count // self.fields)
        shifted = np.zeros((groups * self.fields, width), dtype=np.int64)
        shifted[:self.count] = rows + self.bias
        shifted = shifted.reshape(groups, self.fields, width).astype(kind)
        self.wide = np.zeros((groups, width), dtype=kind)
        for j in range(self.fields):
            self.wide += shifted[:, j] * (float(1 << self.bits * j) if self.doubles else 1 << self.bits * j)
        self.sums = self._total(rows)

    def _total(self, rows):
        return rows.sum(axis=1) if self.doubles else rows.astype(object).sum(axis=1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """``[anchor, candidate]`` exact inner products as int64."""
        if not self.count or not len(anchors):
            return np.zeros((len(anchors), self.count), dtype=np.int64)
        kind = np.float64 if self.doubles else object
        product = (anchors + self.anchor_bias).astype(kind) @ self.wide.T
        if self.doubles:
            product = product.astype(np.int64)
        mask = (1 << self.bits) - 1
        fields = [(product >> self.bits * j) & mask for j in range(self.fields)]
        both = np.stack(fields, axis=2).reshape(len(anchors), -1)[:, :self.count]
        own = self._total(anchors)
        free = both - self.bias * own[:, None] - self.anchor_bias * self.sums[None, :] - self.width * self.bias * self.anchor_bias
        return free.astype(np.int64)


def first_places(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the earlier place, in order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        places = np.concatenate([above, np.flatnonzero(scores == least)[:k - len(above)]])
        places.sort()
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")]


def _matrix(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _product_blocks(anchors: pd.DataFrame, rows: pd.DataFrame, width: int):
    """Anchors one by one (place, scores) against rows in order of id, and
    these rows' ids and labels."""
    rows = rows.iloc[np.argsort(rows["vec_id"].to_numpy(), kind="stable")]
    asked = _matrix(anchors["v"], width)
    packed = Packed(_matrix(rows["v"], width), asked)
    step = max(1, SLICE_SCORES // max(1, len(rows)))
    lines = ((at + i, line) for at in range(0, len(anchors), step) for i, line in enumerate(packed.scores(asked[at:at + step])))
    return lines, rows["vec_id"].to_numpy(), rows["label"].to_numpy()


def _cell_counts(table: DataFrame, cell_rows: int) -> dict[int, int]:
    """Cells of each label bucket: at most ``BUCKETS`` entries."""
    found = table.groupBy(_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["bucket"]: -(-r["n"] // cell_rows) for r in sorted(found)}


def _bucket():
    return F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int")


def _placed(table: DataFrame, counts: dict[int, int], prefix: str) -> DataFrame:
    """``table`` with its cell: label bucket and a part by hash of the row."""
    parts = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[_bucket()]
    return (table.withColumn(f"{prefix}bucket", _bucket())
            .withColumn(f"{prefix}part", F.pmod(F.xxhash64("vec_id", "v"), parts).cast("int")))


def _sent(table: DataFrame, counts: dict[int, int], prefix: str, same: str | None = None) -> DataFrame:
    """Every row once per cell of the other side, or (``same``: the column of
    the row's own bucket) per cell of that bucket only."""
    pairs = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(n).alias("n")) for b, n in counts.items()])
    if same:
        pairs = F.filter(pairs, lambda x: x["b"] == F.col(same))
    return (table.withColumn("_b", F.explode(pairs)).withColumn(f"{prefix}bucket", F.col("_b.b"))
            .withColumn(f"{prefix}part", F.explode(F.sequence(F.lit(0), F.col("_b.n") - 1))).drop("_b"))


def _meet(anchors: DataFrame, rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(anchor rows, candidate rows)`` for every two cells that meet."""
    keys = ["a_bucket", "a_part", "c_bucket", "c_part"]

    def run(key, a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return work(a, c)

    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(run, schema)


def _frame(rows, columns) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype("int64")


def mine(vectors: DataFrame, *, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` of ``vectors(vec_id, embedding, label)``.

    Anchors are rows whose id is divisible by ``every``; their positives are
    the ``positives`` best other rows of their label; for each, the
    ``negatives`` best rows of other labels follow whose score lies within
    ``low`` and ``high`` percent of the positive's. Ties go to smaller ids.

    Rows with a null id, label or vector, or with null or non-finite
    components, take no part. Shorter vectors count as padded with zeros.
    A positive with a negative score has no negatives, as the limits then
    cross. Repeated ids: equal rows ask once, an anchor never meets rows of
    its own id, other repeated rows are candidates each. Too few rows: all
    there are. Empty table: no rows. Scores are exact while they fit 64 bits.
    A cell holds about ``cell_bytes`` of components, in whichever label.
    """
    schema = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
              "negative_score bigint")
    rows = write_table(usable(vectors), "negatives-rows")
    width = rows.agg(F.max(F.size("v")).alias("w")).first()["w"] or 0
    cell = max(64, cell_bytes // (8 * max(1, width)))
    asked = write_table(rows.where(F.col("vec_id") % every == 0).distinct()
                        .withColumn("anchor", F.xxhash64("label", "v")), "negatives-anchors")
    c_counts, a_counts = _cell_counts(rows, cell), _cell_counts(asked, max(16, cell // 4))
    if not a_counts:
        return vectors.sparkSession.createDataFrame([], schema)
    c_placed, a_placed = _placed(rows, c_counts, "c_"), _placed(asked, a_counts, "a_")

    def best(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out, own, names, labels = [], a["label"].tolist(), a["vec_id"].tolist(), a["anchor"].tolist()
        lines, ids, kinds = _product_blocks(a, c, width)
        for i, line in lines:
            same = np.flatnonzero((kinds == own[i]) & (ids != names[i]))
            out += [(names[i], labels[i], ids[same[p]], line[same[p]]) for p in first_places(line[same], positives)]
        return _frame(out, ["anchor_id", "anchor", "positive_id", "positive_score"])

    found = _meet(_sent(a_placed, c_counts, "c_", "a_bucket"), _sent(c_placed, a_counts, "a_", "c_bucket"), best,
                  "anchor_id bigint, anchor bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id", "anchor").orderBy(F.col("positive_score").desc(), "positive_id")
    pairs = write_table(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives),
                        "negatives-positives")
    goals = (pairs.groupBy(F.col("anchor_id").alias("vec_id"), "anchor")
             .agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("got"))
             .select("vec_id", "anchor", F.col("got.place").alias("places"), F.col("got.positive_id").alias("chosen"),
                     F.col("got.positive_score").alias("goals")))
    ready = write_table(a_placed.join(goals, ["vec_id", "anchor"]), "negatives-asked")

    def hard(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        asked = list(zip(*(a[x] for x in ("vec_id", "anchor", "label", "places", "chosen", "goals"))))
        lines, ids, kinds = _product_blocks(a, c, width)
        for i, line in lines:
            name, mark, own, places, chosen, aims = asked[i]
            # scores are integers: the limits round inwards
            limits = [(-(-low * int(g) // 100), high * int(g) // 100) for g in aims]
            near = np.flatnonzero((line >= min(x for x, _ in limits)) & (line <= max(y for _, y in limits))
                                  & (kinds != own) & (ids != name))
            part = line[near]
            for place, positive, goal, (least, most) in zip(places, chosen, aims, limits):
                fit = np.flatnonzero((part >= least) & (part <= most))
                out += [(name, mark, place, positive, goal, ids[near[fit[p]]], part[fit[p]])
                        for p in first_places(part[fit], negatives)]
        return _frame(out, ["anchor_id", "anchor", "place", "positive_id", "positive_score", "negative_id", "negative_score"])

    mined = _meet(_sent(ready, c_counts, "c_"), _sent(c_placed, a_counts, "a_"), hard,
                  "anchor_id bigint, anchor bigint, place bigint, positive_id bigint, positive_score bigint, "
                  "negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "anchor", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return (mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select(*[c.split()[0] for c in schema.split(", ")]))
