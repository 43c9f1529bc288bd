"""Hard negatives, suffix dedup and fill-in-the-middle against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from starcast.llm import fim, negatives, suffixdedup

DOC = "doc_id bigint, text string, row bigint, spans string, packed int, output string"


def write(spark, path, rows, parts=3):
    spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], DOC).repartition(parts).write.parquet(str(path))
    return spark.read.parquet(str(path))


# --- hard negatives ---

def plain_negatives(rows, every, positives=5, negatives_=10):
    use = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, label, v in sorted({(i, l, tuple(v)) for i, l, v in use if i % every == 0}):
        scored = sorted((-dot(v, w), j, m) for j, m, w in use if j != i)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives_]
            out += [(i, p, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit)]
    return sorted(out)


def vectors(n, width, seed, labels=4, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = (centres[label] * 0.4 + rng.normal(size=width)) * scale
        rows.append((i * 5, [float(np.float32(x)) for x in v], label))
    return rows


NEGATIVE_SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, anchor int, d int"


def mined(spark, rows, **options):
    data = [(*r, "x", 1, 2) for r in rows]
    return sorted(tuple(r) for r in negatives.mine(spark.createDataFrame(data, NEGATIVE_SCHEMA).repartition(3), **options).collect())


def test_negatives_against_all_pairs(spark):
    rows = vectors(240, 12, 1)
    rows += [(None, rows[0][1], 1), (7001, None, 1), (7002, rows[3][1], None), (7003, [1.0, None], 1), (7004, [float("nan")] * 12, 2),
             (7005, [float("inf")] * 12, 2), (7100, [], 1), (7200, [0.5, -0.25], 3), (7007, rows[20][1], 2), (7008, rows[20][1], 2),
             (7009, rows[20][1], 2), (7010, rows[20][1], 3), (7011, rows[20][1], 1)]  # ties between ids
    for cell in (64 * 12 * 8, negatives.CELL_BYTES):  # many cells, and one a label
        assert mined(spark, rows, cell_bytes=cell) == plain_negatives(rows, 100)
    assert len(plain_negatives(rows, 100)) > 100


def test_negatives_repeated_rows_and_few(spark):
    rows = vectors(40, 6, 2)
    rows += [rows[0], rows[0], rows[5], (100, rows[7][1], 1)]  # equal anchors ask once; candidates count each
    want = plain_negatives(rows, 100)
    got = mined(spark, rows)
    assert got and [r[:2] + r[4:] for r in got] == [r[:2] + r[4:] for r in want]
    assert mined(spark, []) == [] and mined(spark, rows[1:3]) == []
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == []  # no other label


def test_packed_products_are_exact():
    rng = np.random.default_rng(4)
    for width, size in ((1, 3), (16, 256), (64, 300), (5, 2 ** 28), (0, 1)):
        rows, anchors = rng.integers(-size, size + 1, (37, width)), rng.integers(-size, size + 1, (5, width))
        want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in rows] for a in anchors]
        for bits in (53, 1):  # in doubles where they fit; always in wide integers
            packed = negatives.Packed(rows, anchors, exact_bits=bits)
            assert packed.doubles == (bits == 53 and size < 2 ** 20) and packed.fields >= 2
            assert packed.scores(anchors).tolist() == want
    assert negatives.first_places(np.array([3, 9, 9, 1, 9, 3]), 2).tolist() == [1, 2]
    assert negatives.first_places(np.array([3, 9, 9, 1, 9, 3]), 5).tolist() == [1, 2, 4, 0, 5]


# --- suffix dedup ---

def plain_spans(texts, span, keep_first):
    at = defaultdict(list)
    for d, t in enumerate(texts):
        for i in range(len(t) - span + 1):
            at[t[i:i + span]].append((d, i))
    gone = [np.zeros(len(t), dtype=bool) for t in texts]
    for places in at.values():
        for d, i in (places[1:] if keep_first else places if len(places) > 1 else []):
            gone[d][i:i + span] = True
    return gone


def repeats(seed, n=40, span=24):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé日") for _ in range(rng.randint(2, 7)))
    filler = lambda k: " ".join(word() for _ in range(k))
    passages = [filler(rng.randint(3, 30)) for _ in range(4)]
    texts = []
    for i in range(n):
        parts = [filler(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), filler(rng.randint(0, 12))]
        texts.append("".join(parts))
    texts += [texts[0], texts[0], texts[1][5:], "", None, "a", "x" * 300, "y" + "x" * 60, "ab" * 90, "abc" * 30 + "ab" * 20, "q" * (span - 1),
              "z" * span, "w" * (span + 1), texts[2] + texts[2], "\x00" * 80 + "a", "\x00" * 30]
    return texts


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("hot_runs", [1, 4096])
def test_suffix_dedup_against_all_windows(spark, tmp_path, keep_first, hot_runs):
    span = 24
    texts = repeats(3)
    docs = write(spark, tmp_path / "d", [(i if i % 7 else None, t) for i, t in enumerate(texts)], parts=1)
    # the input's order is the order of copies
    order = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]
    gone = plain_spans([t for _, t in order], span, keep_first)
    want = []
    for (d, t), g in zip(order, gone):
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~g])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], g, [0]]).astype(int)))
        want.append((d, kept, len(t), int(g.sum()), len(edges) // 2, edges.reshape(-1, 2).tolist(), hashlib.sha256(kept).hexdigest()))
    got = suffixdedup.remove_repeats(docs, span=span, keep_first=keep_first, bucket_bytes=2000, hot_runs=hot_runs).collect()
    key = lambda r: (str(r[0]), r[6], r[3], str(r[5]))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[3] for r in want) > 1000


def test_suffix_dedup_over_several_parts_and_none(spark, tmp_path):
    texts = repeats(5, n=90)
    docs = write(spark, tmp_path / "d", list(enumerate(texts)), parts=4)
    gone = plain_spans([(t or "").encode() for t in texts], 24, False)
    got = {r["doc_id"]: r["n_removed"] for r in suffixdedup.remove_repeats(docs, span=24, keep_first=False).collect()}
    assert got == {i: int(g.sum()) for i, g in enumerate(gone)}
    # keeping the first copy leaves each repeated string once
    kept = {r["doc_id"]: r["kept"] for r in suffixdedup.remove_repeats(docs, span=24).collect()}
    whole = {t.encode()[i:i + 24] for t in texts if t for i in range(len(t.encode()) - 23)}
    assert len(kept) == len(texts) and sum(map(len, kept.values())) > sum(len((t or "").encode()) for t in texts) - sum(map(int, got.values()))
    assert whole
    empty = docs.where("false")
    assert suffixdedup.remove_repeats(empty).count() == 0 and suffixdedup.remove_repeats(empty, keep_first=False).count() == 0


def test_longest_previous_factors():
    text = b"abracadabra abracadabra banana"
    places = list(range(len(text) - 4))
    order = suffixdedup.suffix_order(text, places, 4)
    got = suffixdedup.previous_factors(order, suffixdedup.common_prefixes(text, order, 4, block=7).tolist())

    def common(a, b):
        k = 0
        while k < 4 and text[a + k] == text[b + k]:
            k += 1
        return k

    assert got == {p: max((common(p, q) for q in range(p)), default=0) for p in places}


def test_runs_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffixdedup, "SEGMENT", 64)
    rng = random.Random(1)
    for n in (0, 23, 24, 25, 400):
        data = bytes(rng.choice(b"ab") for _ in range(n))
        at = 0
        for _, _, start, count, times in suffixdedup.runs(data, 24):
            assert start == at
            at += count * times
        assert at == max(0, n - 23)


# --- fill in the middle ---

def plain_fim(doc_id, text, rate=50):
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    drawn = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(tokens)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return (doc_id, text.encode(), n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, out.encode(), n, form, len(p), len(m), sha(out), sha(text))


@pytest.mark.parametrize("rate", [50, 100])
def test_fim_against_plain(spark, tmp_path, rate):
    rng = random.Random(2)
    bag = ["a", "Zoë", "日本", "x y", " ", "<P", "P>", "end."]
    rows = [(i, "".join(rng.choice(bag) + rng.choice([" ", "\n", "\t\v ", "", "\x1c", "\x85"]) for _ in range(rng.randint(1, 30)))) for i in range(200)]
    rows += [(300, ""), (301, None), (302, " \n"), (303, "a"), (304, "  a"), (305, "a  "), (306, "has <M> inside"), (None, "no id here"),
             (5, rows[5][1]), (5, "same id"), (307, "word " * 400_000), (-3, "negative id")]
    docs = write(spark, tmp_path / "d", rows)
    got = sorted((tuple(r) for r in fim.fill_in_middle(docs, rate=rate).collect()), key=lambda r: (str(r[0]), r[6]))
    want = sorted((plain_fim(d, t or "", rate) for d, t in rows), key=lambda r: (str(r[0]), r[6]))
    assert got == want
    assert {r[3] for r in got} == {"plain", "spm", "psm"}
    assert fim.fill_in_middle(docs.where("false")).count() == 0


def test_pieces_share_buffers():
    whole = fim.Pieces.of(b"one two three")
    cut = whole.cut(3, 7)
    assert cut.spans == [(0, 0, 3), (0, 3, 7), (0, 7, 13)] and cut.buffers[0] is whole.buffers[0]
    out = cut.permute((2, 0, 1)).marked([b"<S>", b"<P>", b"<M>"])
    assert out.data() == b"<S> three<P>one<M> two" and out.sha256() == hashlib.sha256(out.data()).hexdigest()
    assert fim.restore(out.data(), "spm").data() == b"one two three"
    for form in ("psm", "spm"):
        for a, b in ((0, 0), (0, 13), (13, 13), (4, 9)):
            order = fim.ARRANGEMENTS[form]
            made = whole.cut(a, b).permute(order).marked([fim.SENTINELS[p] for p in order])
            assert fim.restore(made.data(), form).data() == b"one two three"
