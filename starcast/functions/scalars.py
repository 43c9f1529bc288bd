"""Scalar feature functions: ``Column -> Column``, all JVM-side.

Each function is a pure expression so Catalyst keeps it inside whole-stage
codegen (higher-order functions such as ``aggregate`` / ``filter`` run
interpreted but still on the executors, never in Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's for equal features -------
HASH_BASE = 131                # string hash: h = h * 131 + code point
HASH_MODULUS = 4294967296      # ... modulo 2**32
TRUE_TEXT = "True"             # Python literal spellings used in the data
FALSE_TEXT = "False"
NONE_TEXT = "None"
LIST_SEPARATOR = ","           # categories, friends, elite
PATH_SEPARATOR = "$"           # nested feature names: attributes$k2$k3
SINCE_FORMAT = "yyyy-M-d"      # yelping_since, %Y-%m-%d (padding optional)
RATING_MIN = 1.0
RATING_MAX = 5.0
# A dict-literal entry: quoted or bare key, colon, quoted or bare value; and
# a whole flat literal.
_QUOTED = r"""u?'[^'\\]*+(?:\\.[^'\\]*+)*+'|u?"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
_KEY, _VALUE = rf"{_QUOTED}|[^\s'\",:{{}}]++", rf"{_QUOTED}|[^'\",{{}}\[\]()]++"
DICT_ENTRY_PATTERN = rf"({_KEY})\s*+:\s*+({_VALUE})"
_ENTRY = rf"\s*+(?:{_KEY})\s*+:\s*+(?:{_VALUE})\s*+"
DICT_PATTERN = rf"(?s)^\s*+\{{(?:{_ENTRY}(?:,{_ENTRY})*+,?)?+\s*+\}}\s*+$"
QUOTED_PATTERN = r"""(?s)^u?(['"])(.*)\1$"""
STRIP_PATTERN = r"(?U)^\s+|\s+$"   # Unicode whitespace, as str.strip()
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(_c(c), STRIP_PATTERN, "")


def geo_default(c) -> Column:
    """Latitude / longitude: a missing (null) or zero value becomes 0.0."""
    return F.coalesce(_c(c).cast("double"), F.lit(0.0))


def attribute_count(m) -> Column:
    """Number of entries of an attributes map; null map -> 0."""
    m = _c(m)
    return F.when(m.isNull(), F.lit(0)).otherwise(F.size(m))


def true_attribute_rate(m) -> Column:
    """#'True' values / #('True' or 'False') values; 0.0 when none or null."""
    m = _c(m)
    vals = F.map_values(m)
    n_bool = F.size(F.filter(vals, lambda v: v.isin(TRUE_TEXT, FALSE_TEXT)))
    n_true = F.size(F.filter(vals, lambda v: v == TRUE_TEXT))
    return (F.when(m.isNull() | (n_bool == 0), F.lit(0.0))
            .otherwise(n_true.cast("double") / n_bool))


def _piece_count(c) -> Column:
    return F.size(F.split(_c(c), LIST_SEPARATOR, -1))


def category_count(c) -> Column:
    """Comma-separated pieces of ``categories``; null or '' -> 0."""
    c = _c(c)
    return F.when(c.isNull() | (c == ""), F.lit(0)).otherwise(_piece_count(c))


def list_count(c) -> Column:
    """Friends / elite years: the text 'None' -> 0, else comma pieces.

    '' counts as one piece (as ``''.split(',')`` does); a null field, which
    the source never holds, also gives 0.
    """
    c = _c(c)
    return F.when(c.isNull() | (c == NONE_TEXT), F.lit(0)).otherwise(_piece_count(c))


friend_count = list_count
elite_count = list_count


def checkin_total(m) -> Column:
    """Sum of the per-slot check-in counts of a ``map<string,bigint>``."""
    return F.aggregate(F.map_values(_c(m)), F.lit(0).cast("bigint"),
                       lambda acc, x: acc + F.coalesce(x, F.lit(0).cast("bigint")))


def since_epoch(c) -> Column:
    """'yyyy-MM-dd' at UTC midnight -> epoch seconds (bigint).

    ``unix_date`` counts days, so the result does not depend on the session
    time zone.
    """
    day = F.unix_date(F.try_to_date(_c(c), SINCE_FORMAT))
    return (day.cast("bigint") * F.lit(86400)).cast("bigint")


def opening_hours(c) -> Column:
    """'H:M-H:M' -> hours open; an end before the start wraps past midnight
    (+24), equal start and end give 0."""
    ends = F.split(_c(c), "-")

    def minutes(t):
        hm = F.split(t, ":")
        return hm.getItem(0).try_cast("int") * 60 + hm.getItem(1).try_cast("int")

    hours = (minutes(ends.getItem(1)) - minutes(ends.getItem(0))) / F.lit(60.0)
    return F.when(hours < 0, hours + 24.0).otherwise(hours)


def hash32(c) -> Column:
    """Deterministic 32-bit string hash: fold h*131 + code point mod 2**32.

    Exact integer arithmetic for every length (products stay below 2**40).
    """
    chars = F.filter(F.split(_c(c), ""), lambda ch: ch != "")
    return F.aggregate(chars, F.lit(0).cast("bigint"),
                       lambda h, ch: (h * HASH_BASE + F.ascii(ch)) % HASH_MODULUS)


def encode_text(c) -> Column:
    """Model value of a string-typed feature: 'True' -> 1, 'False' -> 0,
    any other text -> hash32(text); null stays null."""
    c = _c(c)
    return (F.when(c == TRUE_TEXT, F.lit(1.0))
            .when(c == FALSE_TEXT, F.lit(0.0))
            .otherwise(hash32(c).cast("double")))


def is_dict_literal(c) -> Column:
    """True when the text starts with '{' and ends with '}'."""
    c = _c(c)
    return c.startswith("{") & c.endswith("}")


def _unquote(c: Column) -> Column:
    """Content of a quoted literal (escaped quotes and backslashes made
    plain); bare text as it is."""
    return F.when(c.rlike(QUOTED_PATTERN),
                  F.regexp_replace(F.regexp_extract(c, QUOTED_PATTERN, 2), r"""\\(['"\\])""", "$1")).otherwise(c)


def parse_dict_literal(c) -> Column:
    """Flat Python dict literal text -> ``map<string,string>`` of raw value
    texts (quotes kept, surrounding blanks removed). Keys are quoted either
    way or bare (numbers, True); of a repeated key the last value wins. Null
    stays null; any other text, nested literals too, raises."""
    c = _c(c)
    keys = F.transform(F.regexp_extract_all(c, F.lit(DICT_ENTRY_PATTERN), 1), _unquote)
    vals = F.transform(F.regexp_extract_all(c, F.lit(DICT_ENTRY_PATTERN), 2), strip)
    entries = F.filter(F.arrays_zip(keys.alias("key"), vals.alias("value")),
                       lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    bad = F.raise_error(F.concat(F.lit("not a flat dict literal: "), c)).cast("map<string,string>")
    return F.when(c.isNull(), F.lit(None)).when(c.rlike(DICT_PATTERN), F.map_from_entries(entries)).otherwise(bad)


def encode_literal(c) -> Column:
    """Model value of one raw value text from a dict literal.

    Quoted text -> its content (then 'True'/'False' -> 1/0, else hash32);
    bare True / False -> 1 / 0; None -> null; a bare number -> its value.
    """
    c = _c(c)
    quoted = c.rlike(QUOTED_PATTERN)
    return (F.when(quoted, encode_text(_unquote(c)))
            .when(c == TRUE_TEXT, F.lit(1.0))
            .when(c == FALSE_TEXT, F.lit(0.0))
            .when(c == NONE_TEXT, F.lit(None).cast("double"))
            .otherwise(c.try_cast("double")))


def clip_rating(c) -> Column:
    """Clip a predicted rating into [1, 5]."""
    return F.least(F.greatest(_c(c).cast("double"), F.lit(RATING_MIN)), F.lit(RATING_MAX))
