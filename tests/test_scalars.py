"""Scalar feature functions on the edge rows of FIXTURES part A."""

from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starcast.functions import scalars as fn


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(expr(F.col("x")).alias("y")).first().y


def py_hash32(s):
    h = 0
    for ch in s:
        h = (h * 131 + ord(ch)) % 4294967296
    return h


@pytest.mark.parametrize("v,want", [(None, 0.0), (0.0, 0.0), (-79.4, -79.4), (33.5, 33.5)])
def test_geo_default(spark, v, want):
    assert one(spark, fn.geo_default, v, "double") == want


@pytest.mark.parametrize("m,want", [
    (None, 0.0), ({}, 0.0), ({"a": "u'x'", "b": "2"}, 0.0),
    ({"a": "True", "b": "True", "c": "False"}, 2 / 3), ({"a": "True", "z": "u'no'"}, 1.0),
])
def test_true_attribute_rate(spark, m, want):
    assert one(spark, fn.true_attribute_rate, m, "map<string,string>") == pytest.approx(want)


@pytest.mark.parametrize("m,want", [(None, 0), ({}, 0), ({"a": "1", "b": "2"}, 2)])
def test_attribute_count(spark, m, want):
    assert one(spark, fn.attribute_count, m, "map<string,string>") == want


@pytest.mark.parametrize("v,want", [(None, 0), ("", 0), ("A", 1), ("A, B", 2), ("A,B,", 3)])
def test_category_count(spark, v, want):
    assert one(spark, fn.category_count, v, "string") == want


@pytest.mark.parametrize("v,want", [("None", 0), ("a", 1), ("a, b", 2), ("", 1), (None, 0)])
def test_list_count(spark, v, want):
    assert one(spark, fn.friend_count, v, "string") == want
    assert one(spark, fn.elite_count, v, "string") == want


def test_checkin_total(spark):
    assert one(spark, fn.checkin_total, {"Fri-0": 2, "Sat-1": 3}, "map<string,bigint>") == 5


@pytest.mark.parametrize("v,want", [("2012-02-29", 1330473600), ("1970-01-01", 0), ("2012-2-9", 1328745600)])
def test_since_epoch(spark, v, want):
    assert one(spark, fn.since_epoch, v, "string") == want


def test_since_epoch_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, fn.since_epoch, "2012-02-29", "string") == 1330473600
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("v,want", [("9:0-17:30", 8.5), ("18:0-2:0", 8.0), ("0:0-0:0", 0.0), ("10:15-10:45", 0.5)])
def test_opening_hours(spark, v, want):
    assert one(spark, fn.opening_hours, v, "string") == pytest.approx(want)


@pytest.mark.parametrize("v,want", [
    ("AZ", 8605), ("2", 50), ("full_bar", 3097044299), ("average", 1659956409), ("u'no'", 186330228),
    ("", 0), (None, None),
])
def test_hash32_fixed(spark, v, want):
    assert one(spark, fn.hash32, v, "string") == want


@pytest.mark.parametrize("v,want", [("True", 1.0), ("False", 0.0), ("2", 50.0), ("u'no'", 186330228.0),
                                    (None, None)])
def test_encode_text(spark, v, want):
    assert one(spark, fn.encode_text, v, "string") == want


@pytest.mark.parametrize("v,want", [("'no'", 14521.0), ("u'no'", 14521.0), ("True", 1.0), ("False", 0.0),
                                    ("None", None), ("3", 3.0), ("'True'", 1.0)])
def test_encode_literal(spark, v, want):
    assert one(spark, fn.encode_literal, v, "string") == want


def test_parse_dict_literal(spark):
    got = one(spark, fn.parse_dict_literal, "{'romantic': False, 'casual': True, u'x': u'a b', 'n': None}",
              "string")
    assert got == {"romantic": "False", "casual": "True", "x": "u'a b'", "n": "None"}
    assert one(spark, fn.is_dict_literal, "{'a': 1}", "string") is True
    assert one(spark, fn.is_dict_literal, "u'no'", "string") is False


@pytest.mark.parametrize("v,want", [(0.3, 1.0), (5.7, 5.0), (3.2, 3.2)])
def test_clip(spark, v, want):
    assert one(spark, fn.clip_rating, v, "double") == want


def test_strip_matches_python(spark):
    s = " \t A b \n"
    assert one(spark, fn.strip, s, "string") == s.strip()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FFF), max_size=40),
                min_size=1, max_size=20))
def test_hash32_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.y for r in df.select(fn.hash32("x").alias("y")).collect()]
    assert got == [py_hash32(t) for t in texts]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 23), st.integers(0, 59), st.integers(0, 23), st.integers(0, 59)),
                min_size=1, max_size=20))
def test_opening_hours_property(spark, slots):
    texts = [f"{a}:{b}-{c}:{d}" for a, b, c, d in slots]

    def ref(t):
        s, e = t.split("-")
        diff = (datetime.strptime(e, "%H:%M") - datetime.strptime(s, "%H:%M")).total_seconds() / 3600
        return diff + 24 if diff < 0 else diff
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.y for r in df.select(fn.opening_hours("x").alias("y")).collect()]
    assert got == [ref(t) for t in texts]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dates(), min_size=1, max_size=10))
def test_since_epoch_property(spark, days):
    texts = [d.isoformat() for d in days]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.y for r in df.select(fn.since_epoch("x").alias("y")).collect()]
    want = [int(datetime.strptime(t, "%Y-%m-%d").replace(tzinfo=timezone.utc).timestamp()) for t in texts]
    assert got == want


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["a", "b", "c", "d"]),
                                st.sampled_from(["True", "False", "u'x'", "2", "None"]), max_size=4),
                min_size=1, max_size=10))
def test_true_rate_property(spark, maps):
    def ref(m):
        vals = [v for v in m.values() if v in ("True", "False")]
        return 0.0 if not m or not vals else sum(v == "True" for v in vals) / len(vals)
    df = spark.createDataFrame([(m,) for m in maps], "x map<string,string>")
    got = [r.y for r in df.select(fn.true_attribute_rate("x").alias("y")).collect()]
    assert got == [ref(m) for m in maps]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab, ", max_size=12)), min_size=1, max_size=10))
def test_category_split_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.y for r in df.select(fn.category_count("x").alias("y")).collect()]
    assert got == [0 if not t else len(t.split(",")) for t in texts]


def test_strip_unicode_whitespace(spark):
    s = "  Coffee & Tea　 "
    assert one(spark, fn.strip, s, "string") == s.strip()


@pytest.mark.parametrize("text, want", [
    ('{"a": True}', {"a": "True"}),
    ("{1: True, 'b': 2}", {"1": "True", "b": "2"}),
    (r"{'it\'s': 'a, b'}", {"it's": "'a, b'"}),
    ("{'a': 1, 'b': 2, 'a': 3}", {"a": "3", "b": "2"}),
    ("{}", {}),
    ("{'a': \"x'y\",}", {"a": "\"x'y\""}),
])
def test_dict_literal_forms(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(fn.parse_dict_literal("t").alias("m")).first()["m"]
    assert got == want


@pytest.mark.parametrize("text", ["{'a': {'b': 1}}", "{'a'}", "{'a': 1 'b': 2}", "plain"])
def test_dict_literal_raises_on_other_text(spark, text):
    with pytest.raises(Exception, match="not a flat dict literal"):
        spark.createDataFrame([(text,)], "t string").select(fn.parse_dict_literal("t")).collect()


def test_double_quoted_literal_is_encoded_by_content(spark):
    row = spark.createDataFrame([("'free'", '"free"')], "a string, b string").select(
        fn.encode_literal("a").alias("a"), fn.encode_literal("b").alias("b")).first()
    assert row["a"] is not None and row["a"] == row["b"]
