"""End-to-end jobs over files in the original formats.

A folder holds ``business.json``, ``checkin.json``, ``photo.json``,
``tip.json`` and ``user.json`` (JSON lines); ratings and pairs are CSV
files with a header. Each job is a chain of lazy DataFrames; the only
driver-side data are metrics, the vocabulary and network weights.

* ``narrow_train_predict``: 31 features -> boosted trees -> clipped
  predictions CSV (one job, train and score).
* ``discover_vocabulary``: feature names and value profile -> text files.
* ``wide_train`` / ``wide_score``: vocabulary-width matrix -> boosted
  trees saved with their vocabulary; distributed scoring later.
* ``mlp_train`` / ``mlp_score``: scaled 31 features -> network weights as
  Parquet; forward-pass scoring. ``mlp_train_wide`` / ``mlp_score_wide``:
  the same over the vocabulary-width matrix.
* ``evaluate``: RMSE, error distribution and missing predictions.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcast.operators import evaluate as ev
from starcast.operators import features as ft
from starcast.operators import mlp as nn
from starcast.operators import scaling as sc
from starcast.operators import trees as tr
from starcast.operators import vocabulary as vb
from starcast.operators import wide as wd
from starcast.operators.joins import (DEFAULT_BROADCAST_BYTES, DEFAULT_HOT_ROWS, co_located, materialize_all,
                                     with_hot_keys, write_table)
from starcast.sources import files as fl

ENTITIES = ["business", "checkin", "photo", "tip", "user"]


RECORD_KEYS = {"business": "business_id", "user": "user_id"}


def read_entities(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five entities. A business or user that comes again replaces the
    record before it, so a pair meets one of each."""
    base = folder.rstrip("/")
    out = {e: fl.read_json_lines(spark, f"{base}/{e}.json", e) for e in ENTITIES if e != "business"}
    placed = {"business": fl.read_business(spark, f"{base}/business.json", {"_at": _position()}),
              "user": out["user"].withColumn("_at", _position())}
    for entity, key in RECORD_KEYS.items():
        rows = placed[entity]
        out[entity] = (rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != "_at"]), "_at").alias("_r"))
                       .select("_r.*"))
    return out


def _position():
    """Place of a row in the input: file, start of its block in the file,
    then row order inside the block (blocks are packed into tasks by size,
    so the row number alone does not follow the files)."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_ratings_ordered(spark: SparkSession, path: str) -> DataFrame:
    """Ratings with ``order_key`` = position in the input (later lines
    win on duplicate pairs), then deduplicated."""
    raw = fl.read_ratings_csv(spark, path).withColumn("order_key", _position())
    return ft.dedupe_last(raw)


def _tables(spark, folder, fill):
    e = read_entities(spark, folder)
    return ft.feature_tables(e["business"], e["checkin"], e["photo"], e["tip"], e["user"], fill=fill)


def narrow_matrices(spark, folder, train_csv, test_csv, *, hot_rows: int | None = DEFAULT_HOT_ROWS,
                    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES):
    """(train matrix with stars, test matrix) over the 31 features."""
    bfeat, bbytes, ufeat, ubytes = _tables(spark, folder, "zero")
    sizes = dict(bfeat_bytes=bbytes, ufeat_bytes=ubytes, broadcast_bytes=broadcast_bytes)
    dims = [bbytes, ubytes]
    train, hot = with_hot_keys(read_ratings_ordered(spark, train_csv), hot_rows, dims, broadcast_bytes)
    train_m = ft.rating_features(train, bfeat, ufeat, keep=["stars"], hot=hot, **sizes)
    test, hot_t = with_hot_keys(fl.read_pairs_csv(spark, test_csv).distinct(), hot_rows, dims, broadcast_bytes)
    test_m = ft.rating_features(test, bfeat, ufeat, hot=hot_t, **sizes)
    return train_m, test_m


def narrow_train_predict(spark, folder, train_csv, test_csv, output_csv=None, *,
                         params: dict = tr.FEW_TREE_PARAMS, n_estimators: int | None = None,
                         hot_rows: int | None = DEFAULT_HOT_ROWS,
                         broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Fit on the training ratings, predict the test pairs, clip, and write
    the predictions CSV when ``output_csv`` is given."""
    train_m, test_m = narrow_matrices(spark, folder, train_csv, test_csv, hot_rows=hot_rows,
                                      broadcast_bytes=broadcast_bytes)
    model = tr.fit_few(train_m, params, n_estimators=n_estimators)
    pred = tr.predict_clip(model, test_m)
    if output_csv:
        fl.write_predictions_csv(pred, output_csv)
    return pred


def discover_vocabulary(spark, business_json, out_dir=None):
    """Feature names (sorted) and every value per feature; written as text
    files ``features`` and ``feature_values`` under ``out_dir``."""
    business = fl.read_business(spark, business_json)
    long = vb.wide_features_long(business)
    if out_dir:  # both outputs read the long form: write it once
        long = write_table(long, "wide-long")
    vocab = vb.feature_vocabulary(long)
    values = vb.feature_values(long)
    if out_dir:
        fl.write_feature_list(vocab, f"{out_dir.rstrip('/')}/features")
        fl.write_feature_values(values, f"{out_dir.rstrip('/')}/feature_values")
    return vocab, values


def _wide_tables(spark, folder, index, handle_unknown):
    e = read_entities(spark, folder)
    width = index.count()
    counts = ft.business_features(e["business"], e["checkin"], e["photo"], e["tip"], fill="null")
    done = materialize_all({
        "cells": wd.with_counts(wd.business_cells(e["business"], index), counts, width),
        "ufeat": ft.user_features(e["user"], e["tip"], fill="null")})
    cells = wd.check_unknown(done["cells"][0], handle_unknown)
    sizes = dict(cells_bytes=wd.cells_bytes(cells), ufeat_bytes=done["ufeat"][2])
    # too large to broadcast: one layout that training, validation and scoring share
    return (co_located(cells, "business_id", sizes["cells_bytes"], name="wide-cells"),
            co_located(done["ufeat"][0], "user_id", sizes["ufeat_bytes"], name="user-features"), width, sizes)


def wide_matrix_for(spark, folder, pairs, index, *, keep=None, handle_unknown="error",
                    hot_rows: int | None = DEFAULT_HOT_ROWS):
    cells, ufeat, width, sizes = _wide_tables(spark, folder, index, handle_unknown)
    pairs, hot = with_hot_keys(pairs, hot_rows, list(sizes.values()))
    return wd.wide_matrix(pairs, cells, ufeat, width, keep=keep, hot=hot, **sizes)


def wide_train(spark, folder, train_csv, model_dir, *, vocabulary: DataFrame | None = None,
               params: dict = tr.WIDE_TREE_PARAMS, n_estimators: int | None = None,
               hot_rows: int | None = DEFAULT_HOT_ROWS):
    """Fit boosted trees on the wide matrix; saves ``model_dir/model`` and
    the vocabulary index ``model_dir/vocabulary`` (Parquet)."""
    if vocabulary is None:
        vocabulary, _ = discover_vocabulary(spark, f"{folder.rstrip('/')}/business.json")
    index = write_table(vb.feature_index(vocabulary), "wide-index")
    train = wide_matrix_for(spark, folder, read_ratings_ordered(spark, train_csv), index, keep=["stars"],
                            hot_rows=hot_rows)
    model = tr.fit_wide(train, wd.zero_slots(index), params, n_estimators=n_estimators)
    tr.save_model(model, f"{model_dir.rstrip('/')}/model", spark)
    index.write.mode("overwrite").parquet(f"{model_dir.rstrip('/')}/vocabulary")
    return model


def wide_score(spark, folder, test_csv, model_dir, output_csv=None, *, handle_unknown="error",
               hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """Distributed scoring with a saved wide model: every partition walks the
    trees over its sparse rows; clipped and optionally written."""
    model = tr.load_model(f"{model_dir.rstrip('/')}/model", spark)
    index = spark.read.parquet(f"{model_dir.rstrip('/')}/vocabulary")
    pairs = fl.read_pairs_csv(spark, test_csv).distinct()
    m = wide_matrix_for(spark, folder, pairs, index, handle_unknown=handle_unknown, hot_rows=hot_rows)
    pred = tr.predict_clip(model, m)
    if output_csv:
        fl.write_predictions_csv(pred, output_csv)
    return pred


def _few_vector(df):
    from pyspark.ml.functions import array_to_vector

    keep = [c for c in ["user_id", "business_id", "stars"] if c in df.columns]
    return df.select(*keep, array_to_vector(F.array(*ft.FEW_FEATURES)).alias("features"))


def mlp_train(spark, folder, train_csv, model_dir, *, val_csv: str | None = None,
              layers=nn.FEW_LAYERS, epochs: int = 20, seed: int = 0,
              hot_rows: int | None = DEFAULT_HOT_ROWS):
    """Fit the 31-feature network (scaled with training min/max); saves the
    weights and the scaler as Parquet under ``model_dir``. Returns the
    per-epoch loss rows."""
    bfeat, bbytes, ufeat, ubytes = _tables(spark, folder, "zero")   # once, for both matrices

    def labelled(csv):
        pairs, hot = with_hot_keys(read_ratings_ordered(spark, csv), hot_rows, [bbytes, ubytes])
        return ft.rating_features(pairs, bfeat, ufeat, keep=["stars"], hot=hot, bfeat_bytes=bbytes,
                                  ufeat_bytes=ubytes)
    train_m = labelled(train_csv)
    stats = sc.minmax_fit(train_m, ft.FEW_FEATURES)
    train = _few_vector(sc.minmax_scale(train_m, ft.FEW_FEATURES, stats))
    val = _few_vector(sc.minmax_scale(labelled(val_csv), ft.FEW_FEATURES, stats)) if val_csv else None
    flat, hist = nn.fit_mlp(train, list(layers), epochs=epochs, validation=val, seed=seed)
    save_weights(spark, flat, layers, stats, model_dir)
    return hist


def mlp_train_wide(spark, folder, train_csv, model_dir, *, val_csv: str | None = None,
                   vocabulary: DataFrame | None = None, epochs: int = 10, seed: int = 0,
                   hidden=tuple(nn.WIDE_LAYERS[1:]), hot_rows: int | None = DEFAULT_HOT_ROWS):
    """Fit the wide network: vocabulary-width matrix with missing -> 0,
    training min/max applied per batch inside the tasks. Saves weights,
    scaler and vocabulary under ``model_dir``; returns the loss rows."""
    if vocabulary is None:
        vocabulary, _ = discover_vocabulary(spark, f"{folder.rstrip('/')}/business.json")
    index = write_table(vb.feature_index(vocabulary), "wide-index")
    cells, ufeat, width, sizes = _wide_tables(spark, folder, index, "error")

    def matrix(csv):
        pairs, hot = with_hot_keys(read_ratings_ordered(spark, csv), hot_rows, list(sizes.values()))
        return wd.wide_matrix(pairs, cells, ufeat, width, keep=["stars"], hot=hot, **sizes)
    train = write_table(matrix(train_csv), "train-matrix")
    val = matrix(val_csv) if val_csv else None
    lo, hi = sc.sparse_minmax_fit(train, width + wd.EXTRA)
    layers = [len(lo), *hidden]
    flat, hist = nn.fit_mlp(train, layers, epochs=epochs, validation=val, seed=seed, scale=(lo, hi))
    save_weights(spark, flat, layers, {"__vector__": (lo, hi)}, model_dir)
    index.write.mode("overwrite").parquet(f"{model_dir.rstrip('/')}/vocabulary")
    return hist


def mlp_score_wide(spark, folder, test_csv, model_dir, output_csv=None, *, handle_unknown="error",
                   hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """Forward pass of the saved wide network for the test pairs (raw
    values, as the reference's network scoring writes them)."""
    flat, layers, stats = load_weights(spark, model_dir)
    index = spark.read.parquet(f"{model_dir.rstrip('/')}/vocabulary")
    pairs = fl.read_pairs_csv(spark, test_csv).distinct()
    m = wide_matrix_for(spark, folder, pairs, index, handle_unknown=handle_unknown, hot_rows=hot_rows)
    pred = nn.score_mlp(m, flat, layers, scale=stats["__vector__"])
    if output_csv:
        fl.write_predictions_csv(pred, output_csv)
    return pred


def save_weights(spark, flat, layers, stats, model_dir):
    chunks = [flat[i:i + nn.CHUNK].tolist() for i in range(0, len(flat), nn.CHUNK)]
    spark.createDataFrame(list(enumerate(chunks)), "chunk int, w array<double>") \
        .write.mode("overwrite").parquet(f"{model_dir.rstrip('/')}/weights")
    meta = json.dumps({"layers": list(layers),
                       "scaler": {k: [list(map(float, x)) if isinstance(x, (list, tuple, np.ndarray)) else x
                                      for x in v] for k, v in stats.items()}})
    spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(
        f"{model_dir.rstrip('/')}/meta")


def load_weights(spark, model_dir):
    rows = spark.read.parquet(f"{model_dir.rstrip('/')}/weights").orderBy("chunk").collect()
    flat = np.concatenate([np.asarray(r.w, dtype=np.float64) for r in rows])
    meta = json.loads(spark.read.json(f"{model_dir.rstrip('/')}/meta").first().meta)
    return flat, meta["layers"], {k: tuple(v) for k, v in meta["scaler"].items()}


def mlp_score(spark, folder, test_csv, model_dir, output_csv=None, *,
              hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """Forward pass for the test pairs with saved weights (no clipping, as
    in the reference's network scoring)."""
    flat, layers, stats = load_weights(spark, model_dir)
    _, test_m = narrow_matrices(spark, folder, test_csv, test_csv, hot_rows=hot_rows)
    x = _few_vector(sc.minmax_scale(test_m, ft.FEW_FEATURES, stats))
    pred = nn.score_mlp(x, flat, layers)
    if output_csv:
        fl.write_predictions_csv(pred, output_csv)
    return pred


def evaluate(spark, truth_csv, predictions_csv):
    """``(rmse_row, error_distribution, missing_pairs)`` DataFrames."""
    truth = read_ratings_ordered(spark, truth_csv)
    pred = ft.dedupe_last(fl.read_predictions_csv(spark, predictions_csv)
                          .withColumn("order_key", _position()), value="prediction")
    return ev.rmse(truth, pred), ev.error_distribution(truth, pred), ev.missing_predictions(truth, pred)
