"""Corpus pipeline: quality, line dedup, near-duplicates, mixing, packing.

Every stage works on all that the one before it kept, and all but the last
return the columns of ``documents``. A stage's output is written to the
shared folder and read back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcast.llm import linededup, mixing, packing, quality, simhash
from starcast.llm.common import table, write_table
from starcast.llm.registry import tokenizer_path, trusted_ids


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity suits their language."""
    return quality.keep_good(docs, trusted_ids(spark, sf_dir))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` (where there
    is such a column) follows the new text."""
    done = linededup.dedup_lines(docs)
    columns = {"text": F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights, globally shuffled."""
    return mixing.mix(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed windows (a repeated document is packed each time)."""
    return packing.digest(packing.pack(docs, tokenizer_path()))


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_duplicates", near_duplicate_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

# The perplexity model, the tokenizer and SimHash can't be said in SQL; the
# tests hold run() against a plain version on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
