"""Operators against plain versions, and on rows that are easy to get wrong."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starcast.llm import editprint, linededup, lm, mixing, packing, quality, sharding, simhash, topk, toxicity
from starcast.llm.common import components
from starcast.llm.registry import tokenizer_path
from tests.llm import plain

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, slot int"


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    bag = ["ant", "bee", "Über", "cat", "it's", "x9", "naïve", "12,5", "日本", "end."] + [f"w{i}" for i in range(80)]
    shared = "This passage is found in many documents, word by word."
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choice(bag) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), ("  " if i % 2 else "") + shared.upper() + "\t")
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, rows[1][1] + " tail"), (103, ""), (104, None), (105, "a"),
             (106, "word " * 9000), (None, "no id"), (None, None), (5, rows[5][1]), (5, "same id, other text"),
             (107, " \n\t"), (108, "<|endoftext|> Ⅷ ½ ﬁ"), (109, "x\n" * 50), (110, shared + "\n" + shared)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    data = [(d, t, [None, "en", "de"][i % 3], [None, "big", "big", "small"][i % 4], 7, 0.5, 3) for i, (d, t) in enumerate(rows)]
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(data, SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(d, i % 4 != 0, i % 9 == 0) for i, (d, _) in enumerate(rows) if i % 3], "doc_id bigint, quality boolean, toxic boolean").select(
        "doc_id", F.col("quality").cast("int"), F.col("toxic").cast("int"))


def key(r):
    return (r[0] is None, r[0] or 0, *map(str, r[1:]))


@pytest.mark.parametrize("task_edges", [1000, 30])
def test_components(spark, task_edges):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    edges += [(5, 5), edges[0], (None, 3)]
    got = dict((r[0], r[1]) for r in components(spark.createDataFrame(edges, "u bigint, v bigint").repartition(8), task_edges=task_edges).collect())
    root = {x: x for e in edges for x in e if x is not None}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = {x: find(x) for e in edges if e[0] is not None and e[0] != e[1] for x in e}
    assert got == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_simhash(docs, rows, none):
    got = sorted([tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()], key=key)
    prints = [plain.simhash(t) for _, t in rows]
    roots = plain.groups(prints)
    least = {}
    for (d, _), f in zip(rows, prints):
        if d is not None:
            least[roots[f]] = min(d, least.get(roots[f], d))
    want = sorted([(d, f"{f:016x}", least.get(roots[f])) for (d, _), f in zip(rows, prints)], key=key)
    assert got == want
    assert simhash.near_duplicates(none).count() == 0
    kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert sorted(x for x in kept if x is not None) == sorted(least.values())
    assert simhash.keep_one(docs).columns == docs.columns


@pytest.mark.parametrize("m", [2, 3, 4])
def test_pigeonhole_links_are_complete(spark, m, monkeypatch):
    rng = np.random.default_rng(m)
    base = rng.integers(-2 ** 62, 2 ** 62, 30)
    fps = set(base.tolist())
    for b in base:
        for _ in range(6):
            x = int(b)
            for bit in rng.choice(62, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    monkeypatch.setattr(simhash, "choose_m", lambda n, tau: m)
    got = {(r["u"], r["v"]) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint")).distinct().collect()}
    assert got == {(a, b) for a in fps for b in fps if b < a and bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3}


def test_line_dedup(docs, rows, none):
    got = sorted([tuple(r) for r in linededup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()], key=key)
    want = sorted([(d, *r) for (d, _), r in zip(rows, plain.line_dedup(rows))], key=key)
    assert got == want
    assert any(r[2] for r in got)
    assert linededup.dedup_lines(none).count() == 0


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    want = sorted((d, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows if d is not None and d != 5)
    for limit in (4096, 2):
        pieces = packing.pack(docs, tokenizer_path(), open_limit=limit).collect()
        back, windows = {}, {}
        for p in pieces:
            ids = np.frombuffer(p["ids"], "<u4").tolist()
            windows.setdefault(p["sequence_id"], []).append((p["offset"], len(ids)))
            if p["doc_id"] is not None and p["doc_id"] != 5:
                back.setdefault(p["doc_id"], []).append((p["start"], ids, p["doc_tokens"]))
        for parts in windows.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at == 2048 or at & (at - 1) == 0
        joined = sorted((d, [i for _, ids, _ in sorted(ps) for i in ids]) for d, ps in back.items())
        assert joined == want
        assert all(total == sum(len(i) for _, i, _ in ps) for ps in back.values() for *_, total in ps)
    r = packing.digest(packing.pack(docs, tokenizer_path())).where("doc_id = 105").first()
    ids = np.array(tok.encode("a", add_special_tokens=False).ids + [1], "<u4").tobytes()
    assert (r["length"], r["ids_crc32"]) == (len(ids) // 4, zlib.crc32(ids))
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_sum_of_squares_rule():
    rng = random.Random(2)
    packer = packing.Packer(lambda r: None, 0, size=32)
    for _ in range(300):
        n = rng.randint(1, 31)
        levels = packer.levels.copy()

        def cost(level):
            after = levels.copy()
            after[level] -= level > 0
            after[level + n] += level + n < 32
            return (after ** 2).sum()

        options = [0] + [x for x in range(1, 33 - n) if levels[x]]
        assert cost(packer.level_for(n)) == min(map(cost, options))
        packer.add(0, b"\0" * 4 * n)


def test_edit_prints(docs, rows, none):
    got = [tuple(r) for r in editprint.edit_prints(docs).collect()]
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted([(d, len(t), plain.edited_sha(t, order[(i + 1) % len(order)][1])) for i, (d, t) in enumerate(order)], key=key)
    assert sorted([r[:3] for r in got], key=key) == want
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", set()).update(r[3] for r in got if d is not None and d != 5 and r[0] == d)
    assert all(len(v) <= 1 for v in by_text.values())
    assert all(0 <= x <= 1 for r in got for x in r[5:7])
    long = [r for r in got if r[1] > 300]
    assert sum(r[5] for r in long) / len(long) > 0.4 and sum(r[6] for r in long) / len(long) < 0.3
    assert editprint.edit_prints(none).count() == 0


def test_edit_prints_do_not_depend_on_ranges(docs, monkeypatch):
    one = sorted([tuple(r) for r in editprint.edit_prints(docs).collect()], key=key)
    monkeypatch.setattr(editprint, "PARTITION_BYTES", 4000)
    assert sorted([tuple(r) for r in editprint.edit_prints(docs).collect()], key=key) == one


def test_walk_of_many_and_few_lanes_agree(rows):
    texts = [t for _, t in rows if t] * 2
    many = editprint.fingerprints(texts, editprint.Places())
    for i in (0, 7, 20):
        assert (editprint.fingerprints([texts[i]], editprint.Places())[0] == many[i]).all()
    near = editprint.fingerprints(["The quick brown fox jumps. " * 30, "The quick brown fux jumps. " + "The quick brown fox jumps. " * 29], editprint.Places())
    assert editprint.likeness(near[:1], near[1:])[0] > 0.8


def test_top_k(spark):
    rng = np.random.default_rng(1)
    data = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    data += [(400, None), (450, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (None, [1.0] * 6), (350, [0.0] * 6),
             (7, [9.0] * 6), (550, data[3][1]), (600, data[3][1]), (600, data[3][1]), (650, [2.0, 1.0])]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in data], "vec_id bigint, embedding array<double>, score int, rank int")
    ok = [(i, [math.floor(256 * x) for x in v] + [0] * (6 - len(v))) for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != q)[:5]
        want += [(q, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    for options in ({}, {"block": 7, "clusters": 5, "sample": 20, "query_block": 4}):
        assert sorted(tuple(r) for r in topk.top_k(df, **options).collect()) == sorted(want)
    assert topk.top_k(df.where("false")).count() == 0
    assert topk.top_k(df.where("vec_id in (0, 1)")).count() == 1


def test_lm(docs, rows, none, spark):
    got = [r.asDict() for r in lm.score(docs, chunk_rows=16, shards=3).collect()]
    again = [r.asDict() for r in lm.score(docs, chunk_rows=64, shards=5).collect()]
    assert len(got) == len(rows)
    train = [t for d, t in rows if plain.fold(d, 7) != 2]
    counts = {}
    for t in train:
        for w in plain.words(t) + [None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        ws = plain.words(t) + [None]
        want.append((d, plain.fold(d, 7) == 2, len(ws), sum(w in counts for w in ws), n,
                     sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in ws)))
    ours = sorted([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got], key=key)
    assert ours == sorted([(*w[:5], round(w[5], 6)) for w in want], key=key)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert np.allclose(sorted(r["score"] for r in got), sorted(r["score"] for r in again))
    assert lm.score(none).count() == 0


def test_lm_weights_follow_the_data():
    import pandas as pd

    octave = lm.BINS_PER_OCTAVE
    strong = pd.DataFrame({"bucket": [3, 3], "uni": [256 + octave, 256], "bi": [256 + 6 * octave, 256 + 5 * octave], "n": [900, 800]})
    weak = pd.DataFrame({"bucket": [4], "uni": [256 + 3 * octave], "bi": [-1], "n": [1000]})
    w = lm.fit_weights(pd.concat([strong, weak]))
    assert np.allclose(w.sum(axis=1), 1)
    assert w[3].argmax() == 2 and w[4].argmax() == 1 and w[0, 2] == 0


def test_quality_model(docs, rows, labels, none):
    ids = labels.where("quality = 1").select("doc_id")
    trusted = {r[0] for r in ids.collect()}
    got = [r.asDict() for r in quality.perplexities(docs, ids, chunk_rows=16).collect()]
    shuffled = [r.asDict() for r in quality.perplexities(docs, ids, chunk_rows=16, broadcast_ids=0).collect()]

    def grams(t):
        s = [2] * (quality.ORDER - 1) + [ord(c) if ord(c) < 4000 else 4000 + (ord(c) >> 8) % 96 for c in t or ""] + [3]
        return [tuple(s[i:i + quality.ORDER]) for i in range(len(s) - quality.ORDER + 1)]

    model = plain.kneser_ney([g for d, t in rows if d is not None and d in trusted and plain.fold(d, 5) != 0 for g in grams(t)], quality.ORDER)
    want = sorted((d is None, d or 0, math.exp(-sum(map(model, grams(t))) / len(grams(t)))) for d, t in rows)
    for found in (got, shuffled):
        ours = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["perplexity"]) for r in found)
        assert [r[:2] for r in ours] == [r[:2] for r in want]
        assert np.allclose([r[2] for r in ours], [r[2] for r in want], rtol=1e-5)
    kept = quality.keep_good(docs, ids)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(rows)
    assert quality.judge(none, ids).count() == 0
    assert quality.keep_good(docs, ids.where("false")).count() == len(rows)


def test_toxicity(spark, none, labels):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(1500):
        bad = i % 8 == 0
        text = [f"w{rng.randint(0, 300)}" .replace("1", "a").replace("2", "b").replace("3", "c") + rng.choice("defgh") for _ in range(40)]
        if bad:
            text[rng.randint(0, 39)] = rng.choice(["vileword", "nastyword"])
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            marks.append((i, int(bad)))
    rows += [(2000, None), (2001, ""), (None, "vileword")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    out = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(out) == len(rows) and all(0 <= s <= 1 for s in out.values())
    held = [i for i in range(1500) if plain.fold(i, 4) == 2]
    found = [i for i in held if out[i] >= 0.3]
    bad = [i for i in held if i % 8 == 0]
    assert len(set(found) & set(bad)) > 0.8 * len(bad) and len(set(found) & set(bad)) > 0.8 * len(found)
    assert out[2000] == out[2001]
    empty = toxicity.train(none, labels)
    assert toxicity.score(none, empty).count() == 0


def test_document_frequencies_cover_all_rows(spark, docs, rows, none):
    n, counts = toxicity.document_frequencies(docs.repartition(5))
    want = np.zeros(toxicity.BUCKETS, np.int64)
    for _, text in rows:
        want[toxicity.features(text or "")] += 1
    assert n == len(rows) and (counts == want).all()
    n, counts = toxicity.document_frequencies(none)
    assert n == 0 and not counts.any()


def test_words_are_chosen_by_the_whole_corpus(spark):
    """The unlabelled sample holds a tenth of the documents; what is neutral in all of them has no weight."""
    rows = [(i, "vileword plain" if i % 10 == 0 else "plain other") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(0, 800, 2)], "doc_id bigint, toxic int")
    weights, _ = toxicity.train(docs, marks, max_unlabelled=60)
    assert set(np.flatnonzero(weights)) == set(toxicity.buckets("vileword")) - set(toxicity.buckets("plain"))


def test_risk_gradient_against_differences():
    """Derivatives of the risk written out plainly, on both sides of the switch."""
    def loss(g):
        return math.log1p(math.exp(-g))

    def parts(p, u, prior):
        negative = sum(loss(-g) for g in u) / len(u) - prior * sum(loss(-g) for g in p) / len(p)
        return prior * sum(loss(g) for g in p) / len(p) + negative, negative

    rng = np.random.default_rng(1)
    for shift, descends in ((2.0, True), (-4.0, False)):
        p, u = rng.normal(2.0, 1, 6), rng.normal(shift, 1, 9)
        negative, gp, gu = toxicity.risk_gradient(p, u, 0.4)
        assert abs(negative - parts(p, u, 0.4)[1]) < 1e-9 and (negative >= 0) == descends
        for part, grad in ((p, gp), (u, gu)):
            for i in range(len(part)):
                at = part[i]
                value = []
                for step in (1e-5, -1e-5):
                    part[i] = at + step
                    value.append(parts(p, u, 0.4)[0] if descends else -parts(p, u, 0.4)[1])
                part[i] = at
                assert abs((value[0] - value[1]) / 2e-5 - grad[i]) < 1e-6


def test_negative_risk_is_not_descended():
    """With no positives among the unlabelled beyond the prior the negative part's estimate turns negative; the fit
    keeps it near zero, where plain descent would drive the unlabelled scores down without end."""
    rng = np.random.default_rng(0)
    pos = [np.array([1, 2, 3], dtype=np.int32)] * 20
    unl = [rng.integers(10, 40, 5).astype(np.int32) for _ in range(200)]
    held, plain_fit = (toxicity.fit_nnpu(pos, unl, 0.4, epochs=60, beta=beta) for beta in (0.0, 1e9))

    def negative(model):
        w, b = model
        return toxicity.risk_gradient(np.array([b + w[f].sum() for f in pos]), np.array([b + w[f].sum() for f in unl]), 0.4)[0]

    assert negative(held) > -0.2 > negative(plain_fit)


@pytest.mark.parametrize("mean", [0.05, 0.9, 3.7, 25.0])
def test_poisson_quantile(mean):
    u = np.random.default_rng(1).random(400)
    assert mixing.poisson_quantile(u, mean).tolist() == [plain.poisson_quantile(x, mean) for x in u]
    big = mixing.poisson_quantile(np.random.default_rng(2).random(20000), 5e5)
    assert abs(big.mean() - 5e5) < 30 and abs(big.std() - math.sqrt(5e5)) < 20


def test_mixing(docs, rows, none, spark):
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "replica", "shuffle_key"]
    got = [r["shuffle_key"] for r in out.collect()]
    assert got == sorted(got)
    many = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                     F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").alias("source"))
    shares = dict((r[0], r[1]) for r in mixing.mix(many, {"a": 1, "b": 3}, total=8000).groupBy("source").count().collect())
    assert abs(shares["a"] - 2000) < 200 and abs(shares["b"] - 6000) < 350 and None not in shares
    flat = dict((r[0], r[1]) for r in mixing.mix(many, alpha=0.0).groupBy("source").count().collect())
    assert all(abs(flat[s] - 20000 / 3) < 400 for s in ("a", "b", None))
    assert mixing.mix(none).count() == 0


def test_sharding(docs, rows, none):
    names = [f"s{i}" for i in range(7)]
    owner = sharding.lookup_table(names, 1009)
    sizes = np.bincount(owner, minlength=7)
    assert sizes.sum() == 1009 and sizes.max() - sizes.min() <= 1
    less = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(owner, less))
    assert moved < 0.35 * 1009  # a seventh has to move
    assert owner == plain.permutation_table(names, 1009) and less == plain.permutation_table(names[:-1], 1009)
    out = sharding.place(docs, names, size=1009)
    assert out.count() == len(rows) and out.columns == [c for c in docs.columns if c != "slot"] + ["slot", "shard"]
    assert all(r["shard"] == names[owner[r["slot"]]] for r in out.collect())
    assert out.where("doc_id = 5").select("shard").distinct().count() == 1
    assert sharding.place(none, names, size=1009).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)
