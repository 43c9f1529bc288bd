"""Extra columns whose names the operators use themselves, other tokenizers, heavy sources."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from starcast.llm import linededup, mixing, packing, quality, simhash
from starcast.llm.registry import tokenizer_path

NAMES = ["doc", "row", "id", "r", "k", "rate", "n", "name", "base", "chunk", "_mix_source", "_mix_rate", "_ld_row", "_ld_n", "_sh_row",
         "_kn_row", "first", "fp", "place", "h1", "Doc"[1:] + "2", "n_dropped_", "keeper"]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    line = "a line that many documents hold, long enough to count here"
    rows = [(i, f"{line}\nbody of document {i} with words {i * 7} and {i * 11}", "en", ["big", "big", "small"][i % 3]) for i in range(30)]
    rows += [rows[0], (None, "no id", None, None), (31, None, "en", "big"), (32, "", None, "small")]
    path = str(tmp_path_factory.mktemp("clash"))
    data = [(*r, *[f"{c}{r[0]}" for c in NAMES]) for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in NAMES)
    spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{path}/docs")
    return spark.read.parquet(f"{path}/docs")


def unharmed(out):
    for r in out.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in NAMES), r


def test_clashing_names(spark, docs):
    ids = spark.createDataFrame([(i,) for i in range(0, 30, 2)], "doc_id bigint")
    kept = quality.keep_good(docs, ids)
    assert kept.columns == docs.columns and kept.count() > 0
    unharmed(kept)
    lines = linededup.dedup_lines(docs)
    assert lines.columns == [*docs.columns, "kept_text", "n_lines", "n_dropped", "dropped_runs"] and lines.count() == docs.count()
    assert lines.agg(F.sum("n_dropped")).first()[0] == 30  # 31 rows hold the line, one keeps it
    unharmed(lines)
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns and one.where("doc_id = 0").count() == 1
    unharmed(one)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "replica", "shuffle_key"] and mixed.count() > 0
    unharmed(mixed)


def test_shuffle_order_and_heavy_sources(spark, docs, monkeypatch):
    weights = {"big": 1.0, "small": 400.0}
    plain = mixing.mix(docs, weights, total=3000)
    keys = [r["shuffle_key"] for r in plain.select("shuffle_key").collect()]
    assert keys == sorted(keys) and min(keys) < 0 < max(keys)
    counts = {(r["doc_id"], r["text"]): r["n"] for r in plain.groupBy("doc_id", "text").agg(F.max("replica").alias("n"), F.count("*").alias("c")).collect()}
    assert max(counts.values()) > mixing.HEAVY_RATE
    rows = sorted(map(str, plain.select("doc_id", "replica", "shuffle_key").collect()))
    monkeypatch.setattr(mixing, "HEAVY_RATE", 10 ** 6)  # the other way gives the same rows
    assert sorted(map(str, mixing.mix(docs, weights, total=3000).select("doc_id", "replica", "shuffle_key").collect())) == rows
    assert mixing.mix(docs.where("false")).count() == 0


def test_tokenizers_of_other_rules(spark):
    from tokenizers import Tokenizer

    word, byte = tokenizer_path(), tokenizer_path("byte_bpe_50k.json")
    assert isinstance(packing.encoder(word), packing.WordEncoder) and isinstance(packing.encoder(byte), packing.TextEncoder)
    text = "plain words  here\n\nIt's 12 o'clock"
    for path in (word, byte):
        want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.encoder(path).ids(text.encode()), "<u4").tolist() == want
