"""The corpus pipeline stage by stage against plain versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starcast.llm.common import write_table
from tests.llm import plain
from tests.llm.test_operators import SCHEMA, corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = corpus(90)
    junk = [(500 + i, "#!§" * (60 + i)) for i in range(4)]
    data = [(d, t, ["en", "de"][i % 2], ["big", "big", "small"][i % 3], 7, 0.5, 3) for i, (d, t) in enumerate(rows + junk)]
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    marks = [(d, 1, 0) for d, _ in rows if d is not None and d % 2 == 0]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, write_table(stage(spark, docs, folder), f"test-{name}"))
        docs = out[name][1]
        if name != "packing":
            assert docs.columns == columns
    before, after = (texts(x) for x in out["quality"])
    assert not {d for d, _ in after} & {500, 501, 502, 503} and len(after) >= 0.9 * len(corpus(90))
    before, after = (texts(x) for x in out["line_dedup"])
    assert order(after) == order([(d, t if not n else kept) for (d, t), (_, n, kept) in zip(before, plain.line_dedup(before))])
    before, after = (texts(x) for x in out["near_duplicates"])
    roots = plain.groups([plain.simhash(t) for _, t in before])
    groups = [roots[plain.simhash(t)] for _, t in after]
    assert len(set(groups)) == len(groups) == len(set(roots.values())) and set(after) <= set(before)
    for d, t in after:
        same = [x for x, u in before if roots[plain.simhash(u)] == roots[plain.simhash(t)] and x is not None]
        assert d == (min(same) if same else None)
    before, after = out["mixing"]
    assert set(texts(after)) <= set(texts(before)) and after.count() > 0
    pieces = out["packing"][1]
    sums = pieces.agg(F.sum("length").alias("n"), F.sum(F.when(F.col("start") == 0, F.col("doc_tokens"))).alias("t")).first()
    assert sums["n"] == sums["t"]


def test_run_is_repeatable(spark, folder):
    want = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    runs = [sorted(map(str, corpus_pipeline.run(spark, folder).select("doc_id", "doc_tokens").distinct().collect())) for _ in range(2)]
    assert runs[0] == runs[1] and runs[0]
    assert set(want) <= set(corpus_pipeline.run(spark, folder).columns)
