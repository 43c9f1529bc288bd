"""Pair scoring over a file-stream source (Structured Streaming).

The same job as batch scoring: pairs ⟕ business features ⟕ user features
-> fitted model -> clipped prediction, but pairs files are picked up as
they land in a folder. The feature tables are static (materialized,
size-checked) and joined stream-static; each micro-batch is scored on the
executors and appended to a Parquet sink. Offsets and sink metadata live
in a checkpoint location in the shared folder, so a restarted query
resumes without rescoring files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starcast.operators import features as ft
from starcast.operators import trees as tr
from starcast.schemas import RATINGS
from starcast.session import scratch_path


def pair_stream(spark: SparkSession, pairs_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of (user_id, business_id) from CSV files with a
    header; a label column, when present, is ignored."""
    reader = spark.readStream.schema(RATINGS).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(pairs_dir).select("user_id", "business_id")


def score_stream(spark: SparkSession, pairs_dir: str, model, bfeat: DataFrame, ufeat: DataFrame,
                 sink_dir: str, *, bfeat_bytes: int | None = None, ufeat_bytes: int | None = None,
                 checkpoint_location: str | None = None, available_now: bool = True):
    """Start the scoring query; returns the ``StreamingQuery``.

    ``available_now=True`` processes every file present and stops (batch
    catch-up with streaming bookkeeping); ``False`` keeps running.
    """
    pairs = pair_stream(spark, pairs_dir)
    feats = ft.rating_features(pairs, bfeat, ufeat, bfeat_bytes=bfeat_bytes, ufeat_bytes=ufeat_bytes)
    pred = tr.predict_clip(model, feats)
    writer = (pred.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
