"""Operators use all their data: each test fails on a sample or a cut."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pandas as pd

from starcast.llm import editprint, lm, nearcopies, quality
from tests.llm import plain


def test_lm_weights_come_from_the_whole_em_fold(spark, tmp_path):
    rng = random.Random(5)
    # documents are alike in pairs of words to a degree that differs by id, so a part of the fold gives other weights
    rows = []
    for i in range(150):
        chain = rng.random()
        text, w = [], 0
        for _ in range(rng.randint(5, 40)):
            w = (w + 1) % 30 if rng.random() < chain else rng.randint(0, 29)
            text.append(f"w{w}")
        rows.append((i, " ".join(text)))
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, chunk_rows=16, shards=3).collect()}

    def sequence(t):
        ws = [*plain.words(t), None]
        return list(zip(["<s>", *ws[:-1]], ws))

    def model(texts):
        word = Counter(w for t in texts for _, w in sequence(t))
        return word, Counter(p for t in texts for p in sequence(t))

    def estimates(word, pair, b, w):
        seen = word[None] if b == "<s>" else word[b]
        bucket = min(int(math.log2(seen)) + 1, lm.BUCKETS - 1) if seen else 0
        floor = 1 / (len(word) + 1)
        return bucket, floor, word[w] / word.total(), pair[b, w] / max(1, seen)

    train = [(d, t) for d, t in rows if plain.fold(d, lm.FOLDS) != lm.HELD_FOLD]
    rest = model([t for d, t in train if plain.fold(d, lm.FOLDS) != lm.EM_FOLD])
    fold = [t for d, t in train if plain.fold(d, lm.FOLDS) == lm.EM_FOLD]
    assert len(fold) > 8
    stats = []
    for t in fold:
        for b, w in sequence(t):
            bucket, floor, uni, bi = estimates(*rest, b, w)
            stats.append((bucket, *lm._bin(np.array([uni / floor, bi / floor])).tolist()))
    stats = pd.DataFrame(stats, columns=["bucket", "uni", "bi"]).groupby(["bucket", "uni", "bi"]).size().rename("n").reset_index()
    weights = lm.fit_weights(stats)
    whole = model([t for _, t in train])
    for d, t in rows:
        want = 0.0
        for b, w in sequence(t):
            bucket, *parts = estimates(*whole, b, w)
            want += math.log10(np.dot(weights[bucket], parts))
        assert math.isclose(got[d], want, rel_tol=1e-6), d


def test_walks_reach_the_end_of_every_text():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(3, 50))) for _ in range(300)]
    other = [t[:-1] + "Z" for t in texts]
    for step in (300, 5):  # many lanes at once, and few
        a, b = (np.concatenate([editprint.fingerprints(ts[i:i + step], editprint.Places()) for i in range(0, 300, step)])
                for ts in (texts, other))
        # one step has the same 4 bits by chance, or shares a bin with a place of lower rank
        assert (a != b).any(axis=1).mean() > 0.9
    # every written place lies within the walk, as a plain walk has it
    places = editprint.Places()
    places.grow(1)
    for t, symbols in zip(texts, a):
        steps = (editprint._mix(np.arange(1000, dtype=np.uint64), 4) >> np.uint64(32)).tolist()
        salts = (editprint._mix(np.arange(1000, dtype=np.uint64), 3) >> np.uint64(32)).tolist()
        written, p = [], 0
        while p < len(t):
            j = len(written)
            written.append((((ord(t[p]) ^ salts[j]) * editprint.MIX) & 0xFFFFFFFF) >> 28)
            p += (((ord(t[p]) + steps[j]) * editprint.MIX) & 0xFFFFFFFF) >> 31
        want = [([written[j] for j in b if j < len(written)] or [editprint.NONE])[-1] for b in places.by_bin]
        assert symbols.tolist() == want


def test_near_copies_against_all_pairs(spark):
    rng = random.Random(7)
    bag = ["alpha", "bird", "cloud", "dune", "ember", "frost", "grain", "hill", "iris", "jade", "knot", "lake"]
    texts = []
    for _ in range(25):
        base = " ".join(rng.choice(bag) + str(rng.randint(0, 99)) for _ in range(rng.randint(6, 60)))
        texts.append(base)
        for _ in range(3):
            t = list(base)
            for _ in range(rng.randint(1, 1 + len(t) // 25)):
                at = rng.randrange(len(t))
                t[at:at + rng.randint(0, 1)] = rng.choice("xyz") * rng.randint(0, 1)
            texts.append("".join(t))
    texts += [texts[0], "", "a", "b", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)  # near copies are not neighbours by id
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row = row, [i]
            for j, e in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != e)))
        return row[-1]

    node = {r["text"]: r["node"] for r in nearcopies._texts(docs).collect()}
    own = sorted({t or "" for _, t in rows})
    want = {}
    for i, a in enumerate(own):
        for b in own[:i]:
            limit = int(max(len(a), len(b)) * nearcopies.EDIT_SHARE)
            if abs(len(a) - len(b)) <= limit:
                d = distance(a, b)
                assert nearcopies.edit_distance(a, b, limit) == (d if d <= limit else None)
                if d <= limit:
                    want[tuple(sorted((node[a], node[b])))] = d
    got = {(r["u"], r["v"]): r["edits"] for r in nearcopies.links(docs).collect()}
    assert len(want) > 100 and all(want.get(k) == d for k, d in got.items())
    assert len(got) >= 0.95 * len(want), (len(got), len(want))
    assert {(r["u"], r["v"]): r["edits"] for r in nearcopies.links(docs, hot_rows=2).collect()} == got  # salted
    out = nearcopies.near_copies(docs).collect()
    assert len(out) == len(rows)
    groups = {r["node"]: r["component_id"] for r in out}
    assert all(groups[u] == groups[v] for u, v in got)
    assert nearcopies.near_copies(docs.where("false")).count() == 0


def test_a_rare_language_is_judged_by_its_own_rows(spark, tmp_path):
    rng = random.Random(8)
    hot = ["time", "house", "river", "stone", "light", "water"]
    letters = "абвгдежзиклмнопрстуфхцчшщыэюя"
    rare = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(hot) for _ in range(40)), "en") for i in range(600)]
    rows += [(1000 + i, " ".join(rng.choice(rare) for _ in range(40)), "xx") for i in range(60)]
    rows += [(2000 + i, "".join(rng.choice("qzxjkvw0189#") for _ in range(200)), "en") for i in range(20)]
    rows += [(3000 + i, " ".join(rng.choice(hot) for _ in range(40)), "none") for i in range(5)]
    rows += [(3005, "".join(rng.choice("qzxjkvw0189#") for _ in range(200)), "none")]
    trusted = [(i,) for i in range(0, 600, 2)] + [(1000 + i,) for i in range(25)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    out = quality.judge(docs, spark.createDataFrame(trusted, "doc_id bigint")).collect()
    n = sum(plain.fold(d, quality.CALIBRATE_FOLDS) == 0 for (d,) in trusted if d >= 1000)
    assert 0 < n < 30  # few rows of the rare language calibrate
    kept = lambda lo, hi: np.mean([r["keep"] for r in out if lo <= r["doc_id"] < hi])
    assert kept(1000, 1060) > 0.95
    assert kept(0, 600) > 0.95 and kept(2000, 2020) == 0
    assert kept(3000, 3005) == 1 and kept(3005, 3006) == 0  # no trusted row: judged from its own median
    assert len({r["high"] for r in out if r["lang"] == "xx"} | {r["high"] for r in out if r["lang"] == "en"}) == 2


def test_bounds_of_many_and_few_rows(spark):
    rng = np.random.default_rng(3)
    many, few = np.exp(rng.normal(1, 0.1, 2000)), np.exp(rng.normal(3, 0.1, 4))
    data = [("a", float(x), True) for x in many] + [("b", float(x), True) for x in few] + [(None, 9.0, True)]
    data += [("a", 1e9, False), ("c", 7.0, False), ("c", 8.0, False), ("c", 900.0, False)]
    schema = "lang string, judged double, calibrates boolean"
    q = {r["l"]: r["q"] for r in quality._bounds(spark.createDataFrame(data, schema), 0.985).collect()}
    pooled = (2000 * np.log(many).var() + 4 * np.log(few).var()) / (1999 + 3)
    spread = math.sqrt((quality.SPREAD_ROWS * pooled + 4 * np.log(few).var()) / (3 + quality.SPREAD_ROWS) * 1.25)
    assert quality.SPREAD_ROWS == 2  # Student's 0.985 quantile is 3.00 at 5 degrees of freedom, 5.64 at 2, 2.17 at 2001
    assert math.isclose((math.log(q["b"]) - np.log(few).mean()) / spread, 3.00, rel_tol=0.02)
    assert math.isclose((math.log(q[None]) - math.log(9)) / math.sqrt(2 * pooled), 5.64, rel_tol=0.06)
    assert math.isclose((math.log(q["c"]) - math.log(8)) / math.sqrt(2 * pooled), 5.64, rel_tol=0.06)
    limit = math.exp(np.log(many).mean() + 2.172 * math.sqrt((2 * pooled + 2000 * np.log(many).var()) / 2001))
    assert math.isclose(q["a"], max(sorted(many)[math.ceil(0.985 * 2000) - 1], limit), rel_tol=1e-3)


def test_one_calibration_row_and_none(spark, tmp_path):
    rng = random.Random(9)
    hot = ["time", "house", "river", "stone", "light", "water"]
    rows = [(i, " ".join(rng.choice(hot) for _ in range(40)), ["en", "de"][i % 2]) for i in range(40)]
    rows += [(100 + i, "".join(rng.choice("qzxjkvw0189#") for _ in range(200)), "en") for i in range(3)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    folds = {0: [], 1: []}
    for i in range(40):
        folds[plain.fold(i, quality.CALIBRATE_FOLDS) == 0].append(i)
    for calibrating in (1, 0):
        ids = folds[0][:20] + folds[1][:calibrating]
        got = {r["doc_id"]: r["keep"] for r in quality.judge(docs, spark.createDataFrame([(i,) for i in ids], "doc_id bigint")).collect()}
        assert all(got[i] for i in range(40)) and not any(got[100 + i] for i in range(3)), calibrating
    nobody = quality.judge(docs, spark.createDataFrame([], "doc_id bigint")).collect()
    assert len(nobody) == 43 and all(r["keep"] for r in nobody)


def test_chunks_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(10)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.choice([0, 5, 50, 4000]))), "en") for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    ids = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id bigint")
    read = lambda **o: {r["doc_id"]: r["perplexity"] for r in quality.perplexities(docs, ids, **o).collect()}
    want = read()
    for options in (dict(chunk_bytes=3000), dict(chunk_rows=1), dict(chunk_bytes=9000, broadcast_ids=0)):
        got = read(**options)
        assert got.keys() == want.keys() and all(math.isclose(got[d], want[d], rel_tol=1e-6) for d in want), options
    parts = list(quality.pieces("abcdefghij", 3))
    whole, cut = quality.grams(["\x02" * 4 + "abcdefghij\x03"])[0], quality.grams(parts)
    assert cut[0].tolist() == whole.tolist() and cut[1].tolist() == [3, 3, 3, 2]
