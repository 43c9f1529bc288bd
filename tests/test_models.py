"""Model invariants (rows-only keys): shapes, ranges, determinism, learning."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from starcast.operators import evaluate as ev
from starcast.operators import features as ft
from starcast.operators import mlp as nn
from starcast.operators import scaling as sc
from starcast.operators import scoring as scr
from starcast.operators import trees as tr


@pytest.fixture(scope="module")
def signal(spark):
    """31 features, label = clipped linear signal + noise (seeded)."""
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 1, size=(1500, 31))
    y = np.clip(1 + 4 * (0.6 * x[:, 0] + 0.4 * x[:, 5]) + rng.normal(0, 0.2, 1500), 1, 5)
    rows = [(f"u{i % 97}", f"b{i}", float(y[i]), *map(float, x[i])) for i in range(1500)]
    cols = ", ".join(f"{c} double" for c in ft.FEW_FEATURES)
    return spark.createDataFrame(rows, f"user_id string, business_id string, stars double, {cols}")


def rmse_of(pred, truth):
    return ev.rmse(truth, pred).first().rmse


def test_gbt_learns_and_clips(spark, signal):
    model = tr.fit_few(signal, n_estimators=60)
    pred = tr.predict_clip(model, signal)
    rows = pred.collect()
    assert len(rows) == signal.count() and all(1.0 <= r.prediction <= 5.0 for r in rows)
    mean = signal.agg(F.avg("stars")).first()[0]
    base = signal.select("user_id", "business_id", F.lit(mean).alias("prediction"))
    assert rmse_of(pred, signal) < 0.7 * rmse_of(base, signal)
    again = tr.predict_clip(tr.fit_few(signal, n_estimators=60), signal)
    assert sorted(r.prediction for r in again.collect()) == sorted(r.prediction for r in rows)


def test_model_roundtrip(spark, signal, tmpdir_path):
    model = tr.fit_few(signal, n_estimators=3)
    path = tr.save_model(model, tmpdir_path + "/m")
    a = {(r.user_id, r.business_id): r.prediction for r in tr.predict_clip(model, signal).collect()}
    b = {(r.user_id, r.business_id): r.prediction for r in tr.predict_clip(tr.load_model(path), signal).collect()}
    assert a == b


def test_tune_trees_table(spark, signal):
    _, table = tr.tune_trees(signal, tree_counts=(2, 6))
    rows = table.orderBy("n_trees").collect()
    assert [r.n_trees for r in rows] == [2, 6] and rows[1].rmse < rows[0].rmse


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, c double")
    out = sc.minmax_scale(df, ["a", "c"]).collect()
    assert [r.c for r in out] == [0.0, 0.0, 0.0] and sorted(r.a for r in out) == [0.0, 0.5, 1.0]
    vec = df.select(array_to_vector(F.array("a", "c")).alias("features"))
    got = [r.features.toArray().tolist() for r in sc.vector_minmax_scale(vec).collect()]
    assert sorted(got) == [[0.0, 0.0], [0.5, 0.0], [1.0, 0.0]]
    stats = sc.minmax_stats(df, ["a", "c"]).orderBy("feature").collect()
    assert [(r.feature, r.fmin, r.fmax) for r in stats] == [("a", 1.0, 3.0), ("c", 5.0, 5.0)]


def test_mlp_gradient_matches_numeric():
    rng = np.random.default_rng(0)
    layers = [4, 5, 3, 1]
    params = nn.init_params(layers, 1)
    x, y = rng.normal(size=(7, 4)), rng.normal(size=7)
    grads, _ = nn._grad(params, x, y)
    eps = 1e-6
    for k in (0, 3, 4):
        p = params[k]
        idx = (0,) * p.ndim
        old = p[idx]
        p[idx] = old + eps
        up = np.mean((nn.forward(params, x) - y) ** 2)
        p[idx] = old - eps
        down = np.mean((nn.forward(params, x) - y) ** 2)
        p[idx] = old
        assert grads[k][idx] == pytest.approx((up - down) / (2 * eps), rel=1e-4, abs=1e-7)


def test_mlp_fit_reduces_loss(spark, signal):
    vec = signal.select("user_id", "business_id", "stars",
                        array_to_vector(F.array(*ft.FEW_FEATURES)).alias("features")).repartition(4)
    flat, hist = nn.fit_mlp(vec, nn.FEW_LAYERS, epochs=6, validation=vec, seed=2)
    var = signal.agg(F.var_pop("stars")).first()[0]   # MSE of the mean predictor
    assert hist[-1][1] < hist[0][1] and hist[-1][2] < 0.85 * var
    flat2, hist2 = nn.fit_mlp(vec, nn.FEW_LAYERS, epochs=6, validation=vec, seed=2)
    assert np.allclose(flat, flat2)
    pred = nn.score_mlp(vec, flat, nn.FEW_LAYERS)
    assert pred.count() == 1500


def test_mlp_fit_is_the_same_for_any_partitioning(spark, signal):
    vec = signal.select("user_id", "business_id", "stars", array_to_vector(F.array(*ft.FEW_FEATURES)).alias("features"))
    setting, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    runs = []
    try:
        for parts, records in [(1, 100), (2, 10_000), (4, 100)]:
            spark.conf.set(setting, str(records))
            runs.append(nn.fit_mlp(vec.repartition(parts), nn.FEW_LAYERS, epochs=2, seed=5, batches=3, block_rows=64))
    finally:
        spark.conf.set(setting, before)
    for flat, hist in runs[1:]:
        assert np.allclose(flat, runs[0][0], rtol=0, atol=1e-9)
        assert np.allclose([h[1] for h in hist], [h[1] for h in runs[0][1]], rtol=0, atol=1e-9)


def test_mlp_fit_without_rows_says_so(spark, signal):
    vec = signal.where("false").select("stars", array_to_vector(F.array(*ft.FEW_FEATURES)).alias("features"))
    with pytest.raises(ValueError, match="no training rows"):
        nn.fit_mlp(vec, nn.FEW_LAYERS, epochs=1)


def test_chunk_size_bounds_summing_group():
    assert nn.chunk_size(8) == nn.CHUNK
    assert nn.chunk_size(1000) * 1000 <= nn.GROUP_WEIGHTS
    assert nn.chunk_size(10 ** 6) * 10 ** 6 <= nn.GROUP_WEIGHTS
    assert nn.chunk_size(10 ** 9) == 1


def test_score_partitions_linear(spark, signal):
    w = [0.1] * 31
    out = scr.score_partitions(signal, scr.LinearModel(w, 1.0), ft.FEW_FEATURES).collect()
    x = {(r.user_id, r.business_id): 1.0 + 0.1 * sum(r[c] for c in ft.FEW_FEATURES) for r in signal.collect()}
    assert all(abs(r.raw - x[(r.user_id, r.business_id)]) < 1e-9 for r in out)


def test_error_distribution_buckets(spark):
    truth = spark.createDataFrame([("u", f"b{i}", 5.0) for i in range(5)], "user_id string, business_id string, stars double")
    pred = spark.createDataFrame([("u", "b0", 4.01), ("u", "b1", 4.0), ("u", "b2", 2.5), ("u", "b3", 2.0),
                                  ("u", "b4", 1.0)], "user_id string, business_id string, prediction double")
    got = [(r.bucket, r.n) for r in ev.error_distribution(truth, pred).orderBy("bucket").collect()]
    assert got == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1)]
    half = pred.where("business_id = 'b0'")
    got = [(r.bucket, r.n) for r in ev.error_distribution(truth, half).orderBy("bucket").collect()]
    assert got == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 0)]
    assert ev.missing_predictions(truth, half).count() == 4


def test_mlp_in_task_scaling_equals_column_scaling(spark, signal):
    vec = signal.select("user_id", "business_id", "stars",
                        (array_to_vector(F.array(*[F.col(c) * 10 + 3 for c in ft.FEW_FEATURES]))).alias("features"))
    stats = sc.vector_minmax_fit(vec)
    pre = sc.vector_minmax_scale(vec, stats=stats)
    flat = nn.flatten(nn.init_params(nn.FEW_LAYERS, 4))
    a = {(r.user_id, r.business_id): r.prediction for r in nn.score_mlp(pre, flat, nn.FEW_LAYERS).collect()}
    b = {(r.user_id, r.business_id): r.prediction
         for r in nn.score_mlp(vec, flat, nn.FEW_LAYERS, scale=stats).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_features_of_every_form(spark):
    """ML vectors (sparse and dense mixed), arrays and sparse structs score alike."""
    from pyspark.ml.linalg import Vectors

    rows = [[0.0, 2.0, 0.0, 5.0], [1.0, 0.0, 0.0, 7.0]]
    vec = spark.createDataFrame([(0, Vectors.sparse(4, [1, 3], [2.0, 5.0])), (1, Vectors.dense(rows[1]))], ["id", "features"])
    arr = spark.createDataFrame([(0, rows[0]), (1, rows[1])], "id int, features array<double>")
    cells = spark.createDataFrame([(0, ([1, 3], [2.0, 5.0])), (1, ([0, 2, 3], [1.0, None, 7.0]))],
                                  "id int, features struct<slots:array<int>,values:array<double>>")
    flat = nn.flatten(nn.init_params([4, 3, 1], 0))
    got = [sorted((r.id, r.prediction) for r in nn.score_mlp(df, flat, [4, 3, 1], keys=["id"]).collect()) for df in (vec, arr, cells)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 2


def test_gradient_sum_ignores_arrival_order():
    rng = np.random.default_rng(7)
    parts = rng.normal(0, 1e3, (50, 64)) * 10.0 ** rng.integers(-8, 8, (50, 1))
    units = [nn.split_units(p) for p in parts]
    pdf = pd.DataFrame({"chunk": np.zeros(50, dtype=np.int32), "coarse": [u[0] for u in units],
                        "fine": [u[1] for u in units]})
    outs = [nn._sum_chunks(pdf.sample(frac=1.0, random_state=s)) for s in range(4)]
    for o in outs:
        assert all(np.array_equal(o[c].iloc[0], outs[0][c].iloc[0]) for c in ("coarse", "fine"))
    total = nn.join_units(outs[0]["coarse"].iloc[0], outs[0]["fine"].iloc[0])
    assert np.allclose(total, parts.sum(axis=0), rtol=1e-9, atol=1e-9)


def test_registered_fits_have_the_reference_counts():
    from starcast.plans import catalog

    assert (catalog.QUERY_TREES, catalog.QUERY_WIDE_TREES) == (800, 300) and tr.TUNED_TREES == (1500, 2500)
    assert (catalog.QUERY_EPOCHS, catalog.QUERY_WIDE_EPOCHS) == (20, 10)
    assert nn.BATCH_ROWS == 32 and nn.ADAM["lr"] == 1e-3


def test_epochs_in_one_task_match_plain_steps(spark):
    """Batches of 32 in key order, Adam at 1e-3; sparse and dense rows alike."""
    rng = np.random.default_rng(8)
    x = np.where(rng.random((100, 4)) < 0.5, rng.uniform(0, 2, (100, 4)), 0.0)
    y = x @ [1.0, 0.5, 0.0, -0.5] + 2
    layers = [4, 6, 1]
    rows = [(i, float(y[i]), ([j for j in range(4) if x[i, j]], [float(v) for v in x[i] if v])) for i in range(100)]
    sparse = spark.createDataFrame(rows, "id int, stars double, features struct<slots:array<int>,values:array<double>>").repartition(3)
    dense = spark.createDataFrame([(i, float(y[i]), x[i].tolist()) for i in range(100)], "id int, stars double, features array<double>")
    scale = ([0.0, -1.0, 0.0, 0.0], [2.0, 2.0, 0.0, 2.0])
    flat, hist = nn.fit_mlp(sparse, layers, epochs=3, validation=dense, seed=4, scale=scale)
    again, same = nn.fit_mlp(dense.repartition(2), layers, epochs=3, validation=sparse, seed=4, scale=scale)
    assert np.allclose(flat, again, rtol=0, atol=1e-6) and np.allclose(hist, same, atol=1e-5)
    keys = {r["id"]: r["k"] for r in sparse.select("id", F.xxhash64(F.lit(4), "id").alias("k")).collect()}
    order = np.array(sorted(range(100), key=keys.get))
    lo, rng_ = nn._scale_arrays(scale)
    params = nn.flatten(nn.init_params(layers, 4))
    params[-1] = y.mean()
    m, v, step = np.zeros_like(params), np.zeros_like(params), 0
    for epoch in range(3):
        turn = order[np.random.default_rng([4, epoch]).permutation(100)]
        for at in range(0, 100, 32):
            some = turn[at:at + 32]
            grads, _ = nn._grad(nn.unflatten(params, layers), (x[some] - lo) / rng_, y[some])
            g, step = nn.flatten(grads), step + 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            rate = 1e-3 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            params = params - rate * m / (np.sqrt(v) + 1e-7)
    assert np.allclose(flat, params, atol=2e-4)
    got = {r["id"]: r["prediction"] for r in nn.score_mlp(sparse, flat, layers, keys=["id"], scale=scale).collect()}
    assert np.allclose([got[i] for i in range(100)], nn.forward(nn.unflatten(flat, layers), (x - lo) / rng_))


def test_mlp_tasks_that_keep_their_blocks_give_the_weights_of_single_steps(spark, signal):
    """120 steps between tasks; a job a step took far longer."""
    import time

    vec = signal.select("user_id", "business_id", "stars", array_to_vector(F.array(*ft.FEW_FEATURES)).alias("features"))
    scale = ([1.0] + [0.0] * 30, [3.0] + [1.0] * 30)
    how = dict(seed=5, block_rows=64, scale=scale, keys=["user_id", "business_id"])
    steps = nn.fit_mlp(vec, nn.FEW_LAYERS, epochs=2, batches=3, tasks=0, **how)
    for tasks in (1, 3):
        kept = nn.fit_mlp(vec, nn.FEW_LAYERS, epochs=2, batches=3, tasks=tasks, validation=vec, **how)
        assert np.array_equal(kept[0], steps[0])
        assert np.allclose([h[:2] for h in kept[1]], [h[:2] for h in steps[1]], rtol=1e-12) and kept[1][1][2] > 0
    started = time.time()
    nn.fit_mlp(vec, nn.FEW_LAYERS, epochs=40, batches=3, tasks=3, **how)
    assert time.time() - started < 30


def test_mlp_block_gradient_matches_the_dense_one():
    rng = np.random.default_rng(3)
    n, layers = 50, [30, 7, 4, 1]
    x = rng.normal(size=(n, 30)) * (rng.random((n, 30)) < np.linspace(0.02, 1, 30))
    y, params = rng.normal(size=n), nn.init_params(layers, 2)
    lo, size = rng.normal(size=30) * (np.arange(30) % 3 == 0), rng.random(30) + 0.5
    at = np.flatnonzero(x.ravel())
    block = (n, at.astype("<i4").tobytes(), x.ravel()[at].tobytes(), y.tobytes(), 30)
    for scale, dense in ((None, x), ((lo, size), (x - lo) / size)):
        held = nn.Held(*block, scale)
        assert 0 < len(held.columns) < 30
        grads, loss = nn._grad(params, dense, y)
        assert np.allclose(held.gradient(params), np.append(nn.flatten(grads), loss), rtol=1e-4, atol=1e-6)
