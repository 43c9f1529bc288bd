"""Wide business features: long form, vocabulary, value profile, index.

Every business record is flattened into long rows
``(business_id, feature, kind, raw, value)``:

* each stripped category token -> value 1 (kind ``category``);
* each map entry ``m[k2]`` -> feature ``m$k2``; a value that is a dict
  literal expands to ``m$k2$k3`` entries instead (kind ``attribute`` or
  ``hours``); hours texts become hours open, other texts are encoded
  (True/False -> 1/0, text -> hash32);
* every other field except the denylist -> its own name (kind
  ``scalar``), numbers as is, text encoded.

A missing value stays null. The entries of a record are one array, built in
one pass over its fields; the long form explodes it, so it never has more
rows per business than the record has fields and categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starcast.functions import scalars as fn
from starcast.operators.joins import write_table
from starcast.schemas import BUSINESS_DENYLIST, BUSINESS_MAPS

KINDS = ("category", "attribute", "hours", "scalar")
DISCOVERY_DENYLIST = BUSINESS_DENYLIST + BUSINESS_MAPS
ENTRY_TYPE = "array<struct<feature:string,kind:string,raw:string,value:double>>"
EXTRA_COLUMN = "extra_entries"


def _entry(feature: Column, kind: str, raw: Column, value: Column) -> Column:
    return F.struct(feature.alias("feature"), F.lit(kind).alias("kind"),
                    raw.cast("string").alias("raw"), value.cast("double").alias("value"))


def map_entries(m: Column, name: Column | str, kind: str) -> Column:
    """Entries of a ``map<string,string>`` field: one per key, or one per key
    of a value that is a dict literal."""
    name = F.lit(name) if isinstance(name, str) else name

    def of(e):
        prefix = F.concat(name, F.lit(fn.PATH_SEPARATOR), e["key"])
        nested = F.transform(
            F.map_entries(fn.parse_dict_literal(e["value"])),
            lambda n: _entry(fn.strip(F.concat(prefix, F.lit(fn.PATH_SEPARATOR), n["key"])), kind,
                             n["value"], fn.encode_literal(n["value"])))
        flat_value = fn.opening_hours(e["value"]) if kind == "hours" else fn.encode_text(e["value"])
        flat = F.array(_entry(fn.strip(prefix), kind, e["value"], flat_value))
        return F.when(fn.is_dict_literal(e["value"]), nested).otherwise(flat)

    return F.flatten(F.transform(F.map_entries(m), of))


def record_entries(business: DataFrame) -> Column:
    """All entries of a business record as one array, in one pass over its
    fields. A column ``extra_entries`` (``sources.files.read_business``)
    holds those of undeclared keys."""
    fields = {f.name: f.dataType for f in business.schema.fields}
    empty = F.array().cast(ENTRY_TYPE)
    parts = []
    if "categories" in fields:
        tokens = F.transform(F.split(F.col("categories"), fn.LIST_SEPARATOR), fn.strip)
        parts.append(F.transform(tokens, lambda t: _entry(t, "category", F.lit(None), F.lit(1.0))))
    for m in BUSINESS_MAPS:
        if m in fields and isinstance(fields[m], T.MapType):
            parts.append(map_entries(F.col(m), m, "hours" if m == "hours" else "attribute"))
    for c in fields:
        if c in DISCOVERY_DENYLIST + ["categories", EXTRA_COLUMN]:
            continue
        if isinstance(fields[c], T.StringType):
            parts.append(F.array(_entry(F.lit(c), "scalar", F.col(c), fn.encode_text(c))))
        else:
            parts.append(F.array(_entry(F.lit(c), "scalar", F.lit(None), F.col(c).cast("double"))))
    if EXTRA_COLUMN in fields:
        parts.append(F.col(EXTRA_COLUMN))
    return F.concat(*[F.coalesce(p.cast(ENTRY_TYPE), empty) for p in parts])


def wide_features_long(business: DataFrame, key: str = "business_id") -> DataFrame:
    """Flatten business records into ``(key, feature, kind, raw, value)``."""
    return business.select(key, F.inline(record_entries(business)))


def flatten_paths(business: DataFrame, key: str = "business_id") -> DataFrame:
    """Map-derived feature names per business (``attributes$..``, ``hours$..``)."""
    long = wide_features_long(business, key)
    return long.where(F.col("kind").isin("attribute", "hours")).select(key, "feature")


def feature_vocabulary(long: DataFrame) -> DataFrame:
    """Distinct feature names with their kind; sort with ``orderBy('feature')``.

    A name seen with two kinds keeps the first kind in ``KINDS`` order.
    """
    rank = F.when(F.col("kind") == "category", 0).when(F.col("kind") == "attribute", 1) \
            .when(F.col("kind") == "hours", 2).otherwise(3)
    return (long.where(~F.col("feature").isin(*DISCOVERY_DENYLIST))
            .groupBy("feature").agg(F.min(rank).alias("_r"))
            .select("feature", F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("_r") + 1).alias("kind")))


def feature_values(long: DataFrame) -> DataFrame:
    """Distinct (feature, raw, value) rows: every value each feature takes,
    nulls included (``raw`` is the source text, null for numbers)."""
    return (long.where(~F.col("feature").isin(*DISCOVERY_DENYLIST))
            .select("feature", "raw", "value").distinct())


def feature_index(vocabulary: DataFrame) -> DataFrame:
    """Dense index 0..n-1 in code-point order of the names.

    Names are sorted by range partitions; a name's index is its row number
    in its partition plus the rows of the partitions before it. Only one
    count per partition reaches the driver.
    """
    placed = write_table(vocabulary.select("feature", "kind").repartitionByRange("feature")
                         .sortWithinPartitions("feature").withColumn("_at", F.monotonically_increasing_id()),
                         "feature-index")
    part = F.shiftright("_at", 33)
    before, starts = 0, []
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], before))
        before += r["count"]
    starts = vocabulary.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    return (placed.join(F.broadcast(starts), part == F.col("_part"))
            .select("feature", "kind", (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("idx")))
