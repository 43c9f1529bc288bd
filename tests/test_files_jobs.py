"""Original-shape JSON/CSV fixtures through readers, features and jobs."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from starcast.operators import features as ft
from starcast.operators import vocabulary as vb
from starcast.operators import wide as wd
from starcast.plans import jobs
from starcast.sources import files as fl


@pytest.fixture(scope="module")
def ents(spark):
    return jobs.read_entities(spark, DATA)


def test_business_features_from_json(spark, ents):
    b = ft.business_features(ents["business"], ents["checkin"], ents["photo"], ents["tip"])
    rows = {r.business_id: r for r in b.collect()}
    b1, b2, b4 = rows["b1"], rows["b2"], rows["b4"]
    assert (b1.b_latitude, b1.b_true_rate, b1.b_categories) == (33.5, 0.5, 2)
    assert (b1.b_checkins, b1.b_photos, b1.b_tips) == (5, 2, 2)
    assert (b2.b_latitude, b2.b_longitude, b2.b_true_rate, b2.b_categories) == (0.0, 0.0, 0.0, 0)
    assert (b2.b_checkins, b2.b_photos, b2.b_tips) == (0, 0, 0)
    assert (b4.b_latitude, b4.b_true_rate, b4.b_categories) == (0.0, 0.0, 0)
    assert rows["b3"].b_true_rate == pytest.approx(2 / 3)


def test_user_features_from_json(spark, ents):
    u = {r.user_id: r for r in ft.user_features(ents["user"], ents["tip"]).collect()}
    assert (u["u1"].u_since, u["u1"].u_friends, u["u1"].u_elite, u["u1"].u_tips) == (1330473600, 2, 3, 2)
    assert (u["u2"].u_friends, u["u2"].u_elite, u["u2"].u_tips) == (0, 0, 1)
    assert (u["u3"].u_friends, u["u3"].u_elite, u["u3"].u_tips) == (1, 1, 0)


def test_ratings_dedupe_and_cold_start(spark, ents, tmpdir_path):
    path = os.path.join(tmpdir_path, "r.csv")
    with open(path, "w") as f:
        f.write("user_id,business_id,stars\nu1,b1,1.0\nu1,b1,5.0\nu9,b9,3.0\n")
    ratings = jobs.read_ratings_ordered(spark, path)
    assert sorted((r.user_id, r.business_id, r.stars) for r in ratings.collect()) == \
        [("u1", "b1", 5.0), ("u9", "b9", 3.0)]
    b = ft.business_features(ents["business"], ents["checkin"], ents["photo"], ents["tip"])
    u = ft.user_features(ents["user"], ents["tip"])
    m = {(r.user_id, r.business_id): r for r in ft.rating_features(ratings, b, u, keep=["stars"]).collect()}
    assert m[("u9", "b9")].cold_start and m[("u9", "b9")].b_stars == 0 and m[("u9", "b9")].u_tips == 0
    assert not m[("u1", "b1")].cold_start and m[("u1", "b1")].b_stars == 4.5
    cold = ft.cold_start_pairs(ratings, b, u).collect()
    assert [(r.user_id, r.unknown_business, r.unknown_user) for r in cold] == [("u9", True, True)]


def test_pairs_reader_ignores_label(spark):
    p = fl.read_pairs_csv(spark, os.path.join(DATA, "val.csv"))
    assert p.columns == ["user_id", "business_id"] and p.count() == 3


def test_wide_long_and_vocabulary(spark, ents, tmpdir_path):
    long = vb.wide_features_long(ents["business"])
    got = {(r.business_id, r.feature): r.value for r in long.collect()}
    assert got[("b1", "attributes$BikeParking")] == 1.0
    assert got[("b1", "attributes$WiFi")] == 186330228.0
    assert got[("b1", "attributes$RestaurantsPriceRange2")] == 50.0
    assert got[("b1", "attributes$Alcohol")] == 3097044299.0
    assert got[("b1", "attributes$NoiseLevel")] == 1659956409.0
    assert got[("b1", "attributes$Ambience$romantic")] == 0.0
    assert got[("b1", "attributes$Ambience$casual")] == 1.0
    assert ("b1", "attributes$Ambience") not in got
    assert got[("b1", "hours$Monday")] == 8.5 and got[("b1", "hours$Friday")] == 8.0
    assert got[("b1", "hours$Sunday")] == 0.0
    assert got[("b1", "state")] == 8605.0
    assert got[("b1", "Coffee & Tea")] == 1.0 and got[("b1", "Food")] == 1.0
    assert got[("b2", "latitude")] is None
    assert not any(f in ("name", "city", "postal_code", "business_id") for _, f in got)
    vocab, values = jobs.discover_vocabulary(spark, os.path.join(DATA, "business.json"), tmpdir_path)
    names = [r.feature for r in vocab.orderBy("feature").collect()]
    assert names == sorted(names) and "Bars" in names and "attributes$Ambience$casual" in names
    lines = spark.read.text(os.path.join(tmpdir_path, "features")).collect()
    assert [r.value for r in lines] == names
    vals = spark.read.text(os.path.join(tmpdir_path, "feature_values")).collect()
    held = dict(r.value.split(" : ", 1) for r in vals)
    assert list(held) == names and held["state"].startswith("[") and "AZ" in held["state"].strip("[]").split(", ")
    fl.write_feature_values(values, os.path.join(tmpdir_path, "parts"), per_line=1)
    parts = [r.value for r in spark.read.text(os.path.join(tmpdir_path, "parts")).collect()]
    assert len(parts) > len(names) and any(" #1/" in p for p in parts)
    whole = {n: sorted(v.strip("[]").split(", ")) for n, v in held.items()}
    again = {}
    for p in parts:
        name, v = p.split(" : ", 1)
        again.setdefault(name.split(" #")[0], []).extend(v.strip("[]").split(", "))
    assert {n: sorted(v) for n, v in again.items()} == whole


def test_feature_index_dense(spark, ents):
    long = vb.wide_features_long(ents["business"])
    idx = vb.feature_index(vb.feature_vocabulary(long)).orderBy("idx").collect()
    assert [r.idx for r in idx] == list(range(len(idx)))
    assert [r.feature for r in idx] == sorted(r.feature for r in idx)
    many = spark.range(5000).select(F.concat(F.lit("f"), F.col("id")).alias("feature"), F.lit("scalar").alias("kind"))
    rows = vb.feature_index(many.repartition(7)).orderBy("idx").collect()
    assert [(r.idx, r.feature) for r in rows] == list(enumerate(sorted(f"f{i}" for i in range(5000))))


def test_later_file_wins_whatever_its_size(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "ratings")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("user_id,business_id,stars\nu,b,1.0\n")
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("user_id,business_id,stars\n" + "".join(f"u{i},b{i},3.0\n" for i in range(500)) + "u,b,4.0\nu,b,5.0\n")
    assert jobs.read_ratings_ordered(spark, folder).where("user_id = 'u'").first().stars == 5.0


def cells_of(rows, pos):
    names = {i: f for f, i in pos.items()}
    return {r.business_id: {names[s]: v for s, v in zip(r.slots, r["values"])} for r in rows.collect()}


def test_wide_cells_and_unknown(spark, ents):
    long = vb.wide_features_long(ents["business"])
    index = vb.feature_index(vb.feature_vocabulary(long))
    pos = {r.feature: r.idx for r in index.collect()}
    got = cells_of(wd.check_unknown(wd.business_cells(ents["business"], index)), pos)
    assert got["b1"]["Food"] == 1.0 and "Food" not in got["b2"]
    assert "latitude" not in got["b2"]  # a null value has no cell
    assert got["b3"]["hours$Monday"] == 12.0 and "hours$Friday" not in got["b3"]
    want = {}
    for r in long.where("value is not null").collect():
        want.setdefault(r.business_id, {})[r.feature] = r.value
    assert {b: c for b, c in got.items() if c} == want
    # the way of large dictionaries gives the same
    assert cells_of(wd.check_unknown(wd.business_cells(ents["business"], index, broadcast_bytes=0)), pos) == got
    zero = wd.zero_slots(index)
    assert len(zero) == len(pos) + 24 and zero[pos["Food"]] and not zero[pos["latitude"]] and not zero[-24:].any()
    small = vb.feature_index(index.where(F.col("feature") != "Food").select("feature", "kind"))
    for limit in (1 << 20, 0):
        cells = wd.business_cells(ents["business"], small, broadcast_bytes=limit)
        with pytest.raises(KeyError, match="Food"):
            wd.check_unknown(cells)
        skipped = {r.business_id: len(r.slots) for r in wd.check_unknown(cells, "skip").collect()}
        assert skipped["b1"] == len(got["b1"]) - 1


def test_wide_cells_take_one_scan_and_no_exchange(spark, tmp_path):
    """Width 100,000: a row costs what its record holds."""
    rows = [(f"b{i}", ", ".join(f"c{(i * 50 + j) % 99_994:05d}" for j in range(50)) + ", c00001") for i in range(2000)]
    spark.createDataFrame(rows, "business_id string, categories string").write.parquet(str(tmp_path / "b"))
    business = spark.read.parquet(str(tmp_path / "b"))
    index = vb.feature_index(vb.feature_vocabulary(vb.wide_features_long(business)))
    width = index.count()
    assert width == 99_994
    cells = wd.business_cells(business, index)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    row = cells.agg(F.sum(F.size("slots")).alias("n"), F.max(F.array_max("slots")).alias("top"), F.sum("n_unknown").alias("u")).first()
    assert row["top"] == width - 1 and row["u"] == 0 and 2000 * 50 <= row["n"] <= 2000 * 51
    assert wd.cells_bytes(cells) < 2000 * 51 * 12 + 2000 * 96 + 1


def test_no_exchange_holds_the_cells(spark, ents, monkeypatch):
    """With broadcast off the cells are bucketed once: the pairs go to them,
    for training and scoring alike, and the result is the broadcast join's."""
    from starcast.operators import joins
    from starcast.plans import catalog

    sf = "/root/testdata/sf0.001"
    want = catalog.wide_matrices(spark, sf)[0]
    want = {(r.user_id, r.business_id): (list(r.features.slots), list(r.features["values"])) for r in want.collect()}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for module in (catalog, joins):
            monkeypatch.setattr(module, "co_located", lambda df, key, size, name: joins.write_bucketed(df, key, name))
        cells, users, width, _, _ = catalog.wide_inputs(spark, sf)
        for split in (True, False):
            pairs = catalog.train_ratings(spark, sf) if split else catalog.valid_ratings(spark, sf)
            m = wd.wide_matrix(joins.write_table(pairs, "pairs"), cells, users, width, broadcast_bytes=0)
            plan = m._jdf.queryExecution().executedPlan().toString()
            exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert len(exchanges) == 2 and plan.count("Bucketed: true") == 2, plan  # the pairs by user, then by business
            if split:
                got = {(r.user_id, r.business_id): (list(r.features.slots), list(r.features["values"])) for r in m.collect()}
                assert got == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_narrow_job_and_evaluate(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "pred")
    pred = jobs.narrow_train_predict(spark, DATA, os.path.join(DATA, "train.csv"), os.path.join(DATA, "val.csv"),
                                     out, n_estimators=3, hot_rows=2)
    rows = pred.collect()
    assert len(rows) == 3 and all(1.0 <= r.prediction <= 5.0 for r in rows)
    header = [ln for f in sorted(os.listdir(out)) if f.endswith(".csv")
              for ln in open(os.path.join(out, f)).read().splitlines()[:1]]
    assert header[0] == "user_id, business_id, prediction"
    rmse, dist, missing = jobs.evaluate(spark, os.path.join(DATA, "val.csv"), out)
    r = rmse.first()
    assert r.n == 3 and r.n_missing == 0 and r.rmse >= 0
    assert sum(x.n for x in dist.collect()) == 3 and missing.count() == 0


def test_wide_and_mlp_jobs(spark, tmpdir_path):
    model_dir = os.path.join(tmpdir_path, "wide")
    jobs.wide_train(spark, DATA, os.path.join(DATA, "train.csv"), model_dir, n_estimators=2)
    pred = jobs.wide_score(spark, DATA, os.path.join(DATA, "val.csv"), model_dir, hot_rows=None)
    assert pred.count() == 3 and all(1 <= r.prediction <= 5 for r in pred.collect())
    nn_dir = os.path.join(tmpdir_path, "nn")
    hist = jobs.mlp_train(spark, DATA, os.path.join(DATA, "train.csv"), nn_dir,
                          val_csv=os.path.join(DATA, "val.csv"), epochs=3)
    assert [h[0] for h in hist] == [1, 2, 3] and all(h[2] is not None for h in hist)
    assert jobs.mlp_score(spark, DATA, os.path.join(DATA, "val.csv"), nn_dir).count() == 3


def test_repeated_header_lines_are_dropped(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "cat.csv")
    with open(path, "w") as f:
        f.write("user_id,business_id,stars\nu1,b1,2.0\nuser_id,business_id,stars\nu2,b2,3.0\n")
    rows = sorted((r.user_id, r.stars) for r in fl.read_ratings_csv(spark, path).collect())
    assert rows == [("u1", 2.0), ("u2", 3.0)]


def test_narrow_job_salted_plan_same_predictions(spark):
    args = (spark, DATA, os.path.join(DATA, "train.csv"), os.path.join(DATA, "val.csv"))
    a = {(r.user_id, r.business_id): r.prediction
         for r in jobs.narrow_train_predict(*args, n_estimators=3).collect()}
    # no broadcast allowed and every key with more than one row is salted
    b = {(r.user_id, r.business_id): r.prediction
         for r in jobs.narrow_train_predict(*args, n_estimators=3, hot_rows=1, broadcast_bytes=0).collect()}
    assert a == b and len(a) == 3


def test_wide_network_jobs(spark, tmpdir_path):
    nn_dir = os.path.join(tmpdir_path, "nn_wide")
    hist = jobs.mlp_train_wide(spark, DATA, os.path.join(DATA, "train.csv"), nn_dir,
                               val_csv=os.path.join(DATA, "val.csv"), epochs=2, hidden=(8, 4, 1))
    assert [h[0] for h in hist] == [1, 2] and all(h[2] is not None for h in hist)
    pred = jobs.mlp_score_wide(spark, DATA, os.path.join(DATA, "val.csv"), nn_dir,
                               os.path.join(tmpdir_path, "nn_wide_pred"))
    assert pred.count() == 3


def test_stars_that_are_no_number_raise(spark, tmp_path):
    (tmp_path / "r.csv").write_text("user_id,business_id,stars\nu,b,4.0\nuser_id,business_id,stars\nu,c,\n")
    got = {r.business_id: r.stars for r in fl.read_ratings_csv(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {"b": 4.0, "c": None}
    (tmp_path / "w.csv").write_text("user_id,business_id,stars\nu,b,abc\n")
    with pytest.raises(Exception, match="stars is not a number"):
        fl.read_ratings_csv(spark, str(tmp_path / "w.csv")).collect()
    assert fl.read_pairs_csv(spark, str(tmp_path / "w.csv")).count() == 1


def test_any_business_key_becomes_a_feature(spark, tmp_path):
    (tmp_path / "b.json").write_text(
        '{"business_id": "b", "stars": 4.0, "noise_level": 3, "kind": "good", "open_late": true, "none": null, "tags": ["x"],'
        ' "more": {"flag": "True", "set": "{\'a\': True, \'b\': 2}"}}\n{"business_id": "c", "noise_level": 2.5}\n')
    vocabulary, values = jobs.discover_vocabulary(spark, str(tmp_path / "b.json"))
    names = {r.feature for r in vocabulary.collect()}
    assert {"noise_level", "kind", "open_late", "none", "tags", "more$flag", "more$set$a", "more$set$b", "stars"} <= names
    assert not names & {"business_id", "more", "more$set", "extra_entries"}
    got = {(r.feature, r.raw): r.value for r in values.collect()}
    assert got[("open_late", None)] == 1.0 and got[("more$set$b", "2")] == 2.0 and got[("kind", "good")] == 233472885.0
    assert {r.value for r in values.where("feature = 'noise_level'").collect()} == {3.0, 2.5, None} - {None}
    assert got[("tags", None)] is None and got[("none", None)] is None


def test_later_record_of_a_business_replaces_the_one_before(spark, tmp_path):
    for entity in jobs.ENTITIES:
        (tmp_path / f"{entity}.json").write_text("")
    (tmp_path / "business.json").write_text(
        '{"business_id": "b", "stars": 1.0}\n{"business_id": "c", "stars": 2.0}\n{"business_id": "b", "stars": 4.5}\n')
    got = {r.business_id: r.stars for r in jobs.read_entities(spark, str(tmp_path))["business"].collect()}
    assert got == {"b": 4.5, "c": 2.0}
