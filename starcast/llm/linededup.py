"""Removal of lines that many documents share, by built-in functions only.

Line keys are hashed to 128 bits, range-partitioned with a salt (so a key
holding a third of all lines spans many partitions) and sorted by document
and position. A window streams over each sorted run and marks the first
line of every document; the runs are summed to the number of documents and
the keeping document per key. What comes back for a document is a
run-length coded keep bitmap, not text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starcast.llm.common import ASCII_SPACE, ascii_lower, row_key, write_table

MIN_CHARS = 40
MIN_DOCS = 5
SALTS = 256


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(h1, h2, doc_id, row, pos)`` of every line whose key is long enough."""
    lines = docs.select(F.col("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("row"),
                        F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.withColumn("key", ascii_lower(F.btrim(F.col("line"), F.lit(ASCII_SPACE))))
    return (keyed.where(F.char_length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
                    "doc_id", "row", "pos"))


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(h1, h2, keeper)`` of keys found in at least ``min_docs`` documents."""
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    ranged = salted.repartitionByRange(F.col("h1"), F.col("h2"), F.col("salt"))
    run = Window.partitionBy("h1", "h2", "salt").orderBy(F.col("doc_id").desc_nulls_last(), F.col("pos"))
    before = F.lag(F.struct("doc_id")).over(run)
    first = F.when(before.isNull() | ~before["doc_id"].eqNullSafe(F.col("doc_id")), 1).otherwise(0)
    firsts = ranged.withColumn("first", first).where("first = 1")
    runs = firsts.groupBy("h1", "h2", "salt").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top"))
    return (runs.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("keeper"))
            .where(F.col("n") >= min_docs).select("h1", "h2", "keeper"))


def keep_bitmaps(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Run-length coded keep bitmaps ``(doc_id, row, n_dropped, dropped_runs)``
    of the documents that lose lines; ``dropped_runs`` lists ``(first, last)``
    line positions and ``row`` is ``common.row_key`` of the document."""
    lines = write_table(line_keys(docs, min_chars), "line-keys")
    repeated = write_table(repeated_keys(lines, min_docs), "line-repeated")
    lost = (lines.join(repeated, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("pos")).alias("at")))
    heads = F.filter("at", lambda p, i: (i == 0) | (F.get(F.col("at"), i - 1) != p - 1))
    tails = F.filter("at", lambda p, i: (i == F.size("at") - 1) | (F.get(F.col("at"), i + 1) != p + 1))
    return lost.select("doc_id", "row", F.size("at").alias("n_dropped"),
                       F.arrays_zip(heads.alias("first"), tails.alias("last")).alias("dropped_runs"))


def dedup_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines``, ``n_dropped`` and
    ``dropped_runs`` added (replacing columns of these names).

    A key is a line stripped of white space at both ends with A-Z
    lower-cased. A key of at least ``min_chars`` code points found in at
    least ``min_docs`` documents stays only in the largest ``doc_id``
    holding it, there with all its lines. Null or empty text: one empty
    line. Rows of one ``doc_id`` count as one document; equal rows get
    equal results; null ids count as one document, the last to keep a key.
    Empty table: no rows.
    """
    new = ["kept_text", "n_lines", "n_dropped", "dropped_runs"]
    docs = docs.drop(*new)
    maps = keep_bitmaps(docs, min_chars=min_chars, min_docs=min_docs).select(
        F.col("doc_id").alias("k"), F.col("row").alias("r"), "n_dropped", "dropped_runs")
    # the documents as one struct, so that no name of theirs can clash
    held = docs.select(F.struct("*").alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("row"))
    all_lines = _lines(F.col("doc.text"))
    joined = held.join(maps, (F.col("row") == F.col("r")) & F.col("doc.doc_id").eqNullSafe(F.col("k")), "left")
    # the kept runs lie between the dropped ones; each is one slice of the lines
    begins = F.concat(F.array(F.lit(0)), F.transform("dropped_runs.last", lambda p: p + 1))
    ends = F.concat(F.col("dropped_runs.first"), F.array(F.size(all_lines)))
    kept = F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(all_lines, a + 1, b - a)))
    text = F.when(F.col("n_dropped").isNull(), F.coalesce("doc.text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    done = joined.select("doc", text.alias("kept_text"), F.size(all_lines).cast("bigint").alias("n_lines"),
                         F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), "dropped_runs")
    return done.select("doc.*", *new)
