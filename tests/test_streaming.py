"""File-stream scoring equals batch scoring."""

import os
import shutil

from conftest import DATA
from starcast.operators import features as ft
from starcast.operators import trees as tr
from starcast.plans import jobs
from starcast.sources import files as fl
from starcast.streaming.scoring import score_stream


def test_stream_matches_batch(spark, tmpdir_path):
    e = jobs.read_entities(spark, DATA)
    bfeat, bbytes, ufeat, ubytes = ft.feature_tables(e["business"], e["checkin"], e["photo"], e["tip"], e["user"])
    train = jobs.read_ratings_ordered(spark, os.path.join(DATA, "train.csv"))
    model = tr.fit_few(
        ft.rating_features(train, bfeat, ufeat, keep=["stars"], bfeat_bytes=bbytes, ufeat_bytes=ubytes), n_estimators=3)
    inbox = os.path.join(tmpdir_path, "inbox")
    os.makedirs(inbox)
    shutil.copy(os.path.join(DATA, "val.csv"), os.path.join(inbox, "part1.csv"))
    sink = os.path.join(tmpdir_path, "sink")
    q = score_stream(spark, inbox, model, bfeat, ufeat, sink, bfeat_bytes=bbytes, ufeat_bytes=ubytes,
                     checkpoint_location=os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    got = {(r.user_id, r.business_id): r.prediction for r in spark.read.parquet(sink).collect()}
    pairs = fl.read_pairs_csv(spark, os.path.join(DATA, "val.csv"))
    want = {(r.user_id, r.business_id): r.prediction
            for r in tr.predict_clip(model, ft.rating_features(pairs, bfeat, ufeat)).collect()}
    assert got == want and len(got) == 3


def test_stream_restart_scores_only_new_files(spark, tmpdir_path):
    e = jobs.read_entities(spark, DATA)
    bfeat, bbytes, ufeat, ubytes = ft.feature_tables(e["business"], e["checkin"], e["photo"], e["tip"], e["user"])
    train = jobs.read_ratings_ordered(spark, os.path.join(DATA, "train.csv"))
    model = tr.fit_few(
        ft.rating_features(train, bfeat, ufeat, keep=["stars"], bfeat_bytes=bbytes, ufeat_bytes=ubytes), n_estimators=2)
    inbox, sink, ckpt = (os.path.join(tmpdir_path, x) for x in ("inbox", "sink", "ckpt"))
    os.makedirs(inbox)
    shutil.copy(os.path.join(DATA, "val.csv"), os.path.join(inbox, "a.csv"))
    kw = dict(bfeat_bytes=bbytes, ufeat_bytes=ubytes, checkpoint_location=ckpt)
    score_stream(spark, inbox, model, bfeat, ufeat, sink, **kw).awaitTermination(120)
    assert spark.read.parquet(sink).count() == 3
    score_stream(spark, inbox, model, bfeat, ufeat, sink, **kw).awaitTermination(120)
    assert spark.read.parquet(sink).count() == 3          # restart: nothing rescored
    with open(os.path.join(inbox, "b.csv"), "w") as f:
        f.write("user_id,business_id\nu1,b3\n")
    score_stream(spark, inbox, model, bfeat, ufeat, sink, **kw).awaitTermination(120)
    assert spark.read.parquet(sink).count() == 4          # only the new file
