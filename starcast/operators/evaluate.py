"""Prediction evaluation: RMSE, error distribution, coverage.

All metrics are single aggregates over the truth ⟕ prediction join; the
only rows that reach the driver are the final metric rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcast.functions.scalars import clip_rating
from starcast.operators.features import PAIR_KEYS

# Error buckets |y - p| in [0,1) [1,2) [2,3) [3,4) [4,inf).
N_ERROR_BUCKETS = 5


def baseline_predictions(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """Bias baseline: item mean + user mean - 3 (clipped to [1, 5]), for
    pairs whose item and user both have training ratings. Used as a
    deterministic stand-in model for the evaluation operators."""
    item = train.groupBy("business_id").agg(F.avg("stars").alias("_im"))
    usr = train.groupBy("user_id").agg(F.avg("stars").alias("_um"))
    p = (pairs.select(*PAIR_KEYS).join(item, "business_id").join(usr, "user_id")
         .select(*PAIR_KEYS, clip_rating(F.col("_im") + F.col("_um") - F.lit(3.0)).alias("prediction")))
    return p


def scored(truth: DataFrame, predictions: DataFrame, label: str = "stars") -> DataFrame:
    """Truth ⟕ predictions on the pair key: label, prediction (null when the
    pair has no prediction)."""
    return truth.select(*PAIR_KEYS, F.col(label).alias("_y")).join(
        predictions.select(*PAIR_KEYS, F.col("prediction").alias("_p")), PAIR_KEYS, "left")


def missing_predictions(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Truth pairs without a prediction (left anti join)."""
    return truth.select(*PAIR_KEYS).join(predictions.select(*PAIR_KEYS), PAIR_KEYS, "left_anti")


def rmse(truth: DataFrame, predictions: DataFrame, label: str = "stars") -> DataFrame:
    """One row: n (scored pairs), n_missing, rmse, rmse_x10k (rounded to 9)."""
    s = scored(truth, predictions, label)
    err2 = F.pow(F.col("_y") - F.col("_p"), 2)
    value = F.sqrt(F.avg(err2))
    return s.agg(F.count("_p").alias("n"),
                 F.sum(F.when(F.col("_p").isNull(), 1).otherwise(0)).cast("bigint").alias("n_missing"),
                 F.round(value, 9).alias("rmse"),
                 F.round(value * 10000, 5).alias("rmse_x10k"))


def rmse_evaluator(truth: DataFrame, predictions: DataFrame, label: str = "stars") -> DataFrame:
    """The same metric through Spark ML's ``RegressionEvaluator``."""
    from pyspark.ml.evaluation import RegressionEvaluator

    s = scored(truth, predictions, label).where(F.col("_p").isNotNull())
    ev = RegressionEvaluator(labelCol="_y", predictionCol="_p", metricName="rmse")
    value = ev.evaluate(s)
    spark = truth.sparkSession
    return spark.range(1).select(F.round(F.lit(float(value)), 9).alias("rmse"))


def error_distribution(truth: DataFrame, predictions: DataFrame, label: str = "stars") -> DataFrame:
    """Counts of |y - p| per unit bucket (last bucket open), zero buckets
    included: bucket, lower, n."""
    spark: SparkSession = truth.sparkSession
    s = scored(truth, predictions, label).where(F.col("_p").isNotNull())
    b = F.least(F.floor(F.abs(F.col("_y") - F.col("_p"))), F.lit(N_ERROR_BUCKETS - 1)).cast("bigint")
    counts = s.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    buckets = spark.range(N_ERROR_BUCKETS).withColumnRenamed("id", "bucket")
    return (buckets.join(F.broadcast(counts), "bucket", "left")
            .select("bucket", F.col("bucket").cast("double").alias("lower"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))
