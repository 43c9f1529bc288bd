"""Source entities derived from the benchmark's Parquet tables.

The rating engine's inputs (ratings, business, user, check-in, photo, tip)
are re-expressed over the star-schema tables so that every job reads whole
tables and grows with them:

* a rating is a line item: user = the order's customer, business = the
  part, stars = 1 + quantity mod 5; ``order_key`` orders duplicates
  (later wins) and carries the rating so that ties cannot disagree;
* a business is a part, a user is a customer with order statistics;
* check-ins, photos and tips are ``signup``, ``view`` and ``click``
  events whose ``props.k`` names the business.

Value derivations below (modulo rules that blank some fields, the
attribute texts) only shape values; no rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcast.schemas import USER_COUNTERS

# Orders on or after this day form the validation set (time-based split).
VALIDATION_FROM = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a scan of few splits dealt over all task slots by ``key``. A file
    is split by bytes, and a small, well-compressed one lands in one task
    whatever work its rows mean; a scan of many splits stays as it is."""
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, key)


def _flag(cond) -> "F.Column":
    return F.when(cond, F.lit("True")).otherwise(F.lit("False"))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a rating: user_id, business_id, stars, order_key,
    is_validation. Duplicated (user, business) pairs are kept."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    q = F.col("l_quantity").cast("bigint") % 5
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("business_id"),
                    (q + 1).cast("double").alias("stars"),
                    (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10 + q).alias("order_key"),
                    (F.col("o_orderdate").cast("date") >= F.to_date(F.lit(VALIDATION_FROM))).alias("is_validation")))


def raw_split(spark: SparkSession, sf_dir: str, validation: bool) -> DataFrame:
    """Train (``validation=False``) or validation ratings, duplicates kept."""
    r = raw_ratings(spark, sf_dir)
    return r.where(F.col("is_validation") == F.lit(validation)).drop("is_validation")


def business(spark: SparkSession, sf_dir: str, spread_rows: bool = False) -> DataFrame:
    """Business records in the source shape: scalars, ``categories`` text,
    ``attributes`` map (flat values and one nested dict literal) and
    ``hours`` map. ``spread_rows`` is for work that takes long per record."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    if spread_rows:
        p = spread(p, "p_partkey")
    key, size = F.col("p_partkey"), F.col("p_size")
    blank_geo = key % 11 == 0
    parking = F.concat(F.lit("{'garage': "), _flag(key % 5 == 0),
                       F.lit(", 'lot': "), _flag(size % 2 == 0),
                       F.lit(", 'valet': None}"))
    attributes = F.create_map(
        F.lit("small"), _flag(size < 10),
        F.lit("metal"), _flag(key % 3 == 0),
        F.lit("kind"), F.concat(F.lit("u'"), F.lower(F.col("p_type")), F.lit("'")),
        F.lit("price"), (size % 4 + 1).cast("string"),
        F.lit("parking"), parking,
    )
    hours = F.create_map(
        F.lit("Monday"), F.concat((size % 24).cast("string"), F.lit(":0-"),
                                  ((key * 7) % 24).cast("string"), F.lit(":30")),
        F.lit("Friday"), F.concat((key % 12).cast("string"), F.lit(":15-"),
                                  (key % 12 + 8).cast("string"), F.lit(":45")),
    )
    return p.select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        F.when(blank_geo, F.lit(None)).otherwise(F.col("p_retailprice") / 100).alias("latitude"),
        F.when(blank_geo, F.lit(None)).otherwise((-size).cast("double")).alias("longitude"),
        (size % 5 + 1).cast("double").alias("stars"),
        size.cast("bigint").alias("review_count"),
        (key % 2).cast("bigint").alias("is_open"),
        F.col("p_type").alias("state"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(
            F.concat_ws(", ", F.col("p_type"), F.col("p_brand"), F.regexp_replace(F.col("p_name"), " ", ", "),
                        *[F.concat_ws(" ", *pair) for pair in (("p_brand", "p_size"), ("p_type", "p_size"), ("p_type", "p_brand"))]
                        )).alias("categories"),
        F.when(key % 17 == 0, F.lit(None)).otherwise(attributes).alias("attributes"),
        hours.alias("hours"),
    )


def user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records: customers with their order count and first order day."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    stats = (table(spark, sf_dir, "orders")
             .groupBy("o_custkey")
             .agg(F.count(F.lit(1)).alias("n_orders"), F.min("o_orderdate").alias("first_order")))
    key = F.col("c_custkey")
    n = F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint")
    friends = (F.when(key % 5 == 0, F.lit("None"))
               .when(key % 5 == 1, F.lit("a"))
               .otherwise(F.concat(F.lit("a,b,"), F.col("c_nationkey").cast("string"))))
    counters = [((key * (i + 3) + n) % (20 + 5 * i)).cast("bigint").alias(name)
                for i, name in enumerate(USER_COUNTERS)]
    return (c.join(stats, c.c_custkey == stats.o_custkey, "left")
            .select(key.alias("user_id"),
                    n.alias("review_count"),
                    F.coalesce(F.date_format("first_order", "yyyy-MM-dd"), F.lit("2000-01-01")).alias("yelping_since"),
                    friends.alias("friends"),
                    F.when(key % 3 == 0, F.lit("None")).otherwise(F.lit("2015,2016")).alias("elite"),
                    (F.col("c_acctbal") / 1000).alias("average_stars"),
                    *counters))


def _events(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == event_type)
    return ev.withColumn("business_id", F.get_json_object("props", "$.k").try_cast("bigint")) \
             .where(F.col("business_id").isNotNull())


def checkin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check-in records: business_id, ``time`` map 'Day-hour' -> count.

    Two-stage aggregation: (business, slot) counts first (map-side
    combined), so each business's map holds at most 7*24 entries.
    """
    ev = _events(spark, sf_dir, "signup")
    slot = F.concat(F.date_format("ts", "E"), F.lit("-"), F.hour("ts").cast("string"))
    per_slot = ev.groupBy("business_id", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    return per_slot.groupBy("business_id").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("time"))


def photo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "view").select("business_id")


def tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "click").select("business_id", "user_id")


def entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five entities keyed by source name."""
    return {"business": business(spark, sf_dir), "checkin": checkin(spark, sf_dir),
            "photo": photo(spark, sf_dir), "tip": tip(spark, sf_dir), "user": user(spark, sf_dir)}
