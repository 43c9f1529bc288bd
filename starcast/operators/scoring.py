"""Partition-wise batch scoring with a model that is not a Spark ML model.

The model (a small picklable object) is shipped once per executor by
broadcast; each task scores its partition Arrow batch by Arrow batch with
numpy and emits ``keys + raw``. Nothing is collected; the output is a lazy
DataFrame that the caller clips, writes or evaluates.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starcast.operators.features import PAIR_KEYS

from starcast.session import ship_by_value

# Functions of this module run inside Python workers: ship them by value so
# executors need no installed copy of the package.
ship_by_value(__name__)


class LinearModel:
    """y = intercept + x . weights (a fixed, fully specified model)."""

    def __init__(self, weights, intercept: float):
        self.weights = np.asarray(weights, dtype=np.float64)
        self.intercept = float(intercept)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.intercept + x @ self.weights


def score_partitions(df: DataFrame, model, columns: list[str], *, keys: list[str] = PAIR_KEYS,
                     predict: Callable | None = None) -> DataFrame:
    """``keys`` + ``raw`` prediction of ``model.predict`` over ``columns``."""
    from pyspark import cloudpickle

    # Broadcasts use plain pickle; cloudpickle bytes carry the model's class
    # by value, so executors need no installed copy of its module.
    bc = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("raw", T.DoubleType())])

    def run(it):
        from pyspark import cloudpickle as cp

        m = cp.loads(bc.value)
        fn_ = predict or m.predict
        for pdf in it:
            if len(pdf) == 0:
                continue
            x = pdf[columns].to_numpy(dtype=np.float64)
            out = pdf[keys].copy()
            out["raw"] = np.asarray(fn_(x), dtype=np.float64)
            yield out
    return df.select(*keys, *columns).mapInPandas(run, schema)
