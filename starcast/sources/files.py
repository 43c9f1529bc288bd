"""File sources and sinks in the original entity formats.

Readers always pass an explicit schema (no inference pass over the data)
and return lazy DataFrames; writers write directories of part files from
the executors (no driver loop).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starcast.functions import scalars as fn
from starcast.schemas import ENTITY_SCHEMAS, PREDICTIONS, RATINGS

# Fixed value: header of the predictions file, as the reference writes it.
PREDICTIONS_HEADER = ["user_id", " business_id", " prediction"]


def _drop_header_rows(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop every line that repeats the header (not only the first one),
    e.g. when files with headers were concatenated."""
    same = None
    for n in names:
        cond = F.trim(F.col(n).cast("string")) == F.lit(n)
        same = cond if same is None else same & cond
    return df.where(~F.coalesce(same, F.lit(False)))


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ratings CSV with a header line: user_id, business_id, stars. Empty
    stars are null; stars that are no number raise when they are read."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RATINGS.fields])
    df = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").csv(path)
    given = F.col("stars")
    wrong = F.raise_error(F.concat(F.lit("stars is not a number: "), given)).cast("double")
    stars = F.when(F.coalesce(F.trim(given), F.lit("")) != "", F.coalesce(given.try_cast("double"), wrong))
    return _drop_header_rows(df, ["user_id", "business_id"]).withColumn("stars", stars)


def read_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Pairs to score: the first two columns of a CSV with header; a third
    (label) column, when present, is ignored."""
    return read_ratings_csv(spark, path).select("user_id", "business_id")


def read_json_lines(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """One JSON record per line, typed by the entity's schema
    (``business``, ``checkin``, ``photo``, ``tip`` or ``user``)."""
    return spark.read.schema(ENTITY_SCHEMAS[entity]).json(path)


def read_business(spark: SparkSession, path: str, also: dict[str, Column] | None = None) -> DataFrame:
    """Business records with every top-level key: the declared fields, typed,
    and ``extra_entries``, the feature entries of all other keys.

    An undeclared text, number, boolean or null is a feature of its own name,
    a map one feature per key (``operators.vocabulary.map_entries``), a list
    a feature without a value. One scan of the text; the record is taken as a
    map of variants once for its undeclared keys. ``also`` are further
    columns over the text rows (their place in the input, say).
    """
    from starcast.operators import vocabulary as vb

    known = ENTITY_SCHEMAS["business"]
    rows = spark.read.text(path).select(
        F.from_json("value", known).alias("r"), F.from_json("value", "map<string,variant>").alias("v"),
                                        *[c.alias(name) for name, c in (also or {}).items()])
    extra = F.map_filter("v", lambda k, _: ~k.isin(*known.names))

    def entries(e):
        kind, text = F.schema_of_variant(e["value"]), F.try_variant_get(e["value"], "$", "string")
        value = (F.when(kind == "STRING", fn.encode_text(text))
                 .when(kind.startswith("ARRAY"), F.lit(None).cast("double"))
                 .otherwise(F.coalesce(F.try_variant_get(e["value"], "$", "double"),
                                       F.try_variant_get(e["value"], "$", "boolean").cast("double"))))
        one = F.struct(fn.strip(e["key"]).alias("feature"), F.lit("scalar").alias("kind"),
                       F.when(kind == "STRING", text).alias("raw"), value.alias("value"))
        nested = vb.map_entries(F.try_variant_get(e["value"], "$", "map<string,string>"), e["key"], "attribute")
        return F.when(kind.startswith("OBJECT"), nested).otherwise(F.array(one).cast(vb.ENTRY_TYPE))

    found = F.flatten(F.transform(F.map_entries(extra), entries))
    return rows.select("r.*", F.coalesce(found, F.array().cast(vb.ENTRY_TYPE)).alias(vb.EXTRA_COLUMN), *(also or {}))


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Predictions CSV (header names may carry leading blanks)."""
    df = (spark.read.schema(PREDICTIONS).option("header", True)
          .option("ignoreLeadingWhiteSpace", True).csv(path))
    return _drop_header_rows(df, ["user_id", "business_id"])


def write_predictions_csv(predictions: DataFrame, path: str) -> str:
    """Write ``user_id, business_id, prediction`` with the reference header."""
    out = predictions.select(*[F.col(c).alias(h) for c, h in
                               zip(["user_id", "business_id", "prediction"], PREDICTIONS_HEADER)])
    (out.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).csv(path))
    return path


def write_ratings_csv(ratings: DataFrame, path: str) -> str:
    ratings.select("user_id", "business_id", "stars").write.mode("overwrite") \
        .option("header", True).csv(path)
    return path


def write_json_lines(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_feature_list(vocabulary: DataFrame, path: str) -> str:
    """One feature name per line, in code-point order across part files."""
    vocabulary.select(F.col("feature").alias("value")).orderBy("value") \
        .write.mode("overwrite").text(path)
    return path


VALUES_PER_LINE = 100_000


def write_feature_values(values: DataFrame, path: str, per_line: int = VALUES_PER_LINE) -> str:
    """``name : [values]``, one line per feature, sorted by name, its values by
    text. A feature of more than ``per_line`` values takes several lines,
    ``name #1/3 : [values]``, dealt by a hash of the value, so that no line is
    unbounded."""
    shown = F.coalesce(F.col("raw"), F.col("value").cast("string"), F.lit("None"))
    texts = values.select("feature", shown.alias("_v")).distinct()
    lines = texts.groupBy("feature").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_line)).alias("_n"))
    dealt = texts.join(lines, "feature").withColumn("_k", F.pmod(F.xxhash64("_v"), F.col("_n")))
    grouped = dealt.groupBy("feature", "_n", "_k").agg(F.sort_array(F.collect_list("_v")).alias("_l"))
    name = F.when(F.col("_n") == 1, F.col("feature")).otherwise(
        F.concat("feature", F.lit(" #"), (F.col("_k") + 1).cast("string"), F.lit("/"), F.col("_n").cast("string")))
    text = F.concat(name, F.lit(" : ["), F.array_join("_l", ", "), F.lit("]"))
    grouped.orderBy("feature", "_k").select(text.alias("value")).write.mode("overwrite").text(path)
    return path
