"""Narrow (31-column) feature tables and the rating feature matrix.

Plan shape: the photo / tip / check-in inputs are aggregated to one row per
key before any join (partial + final hash aggregate, so a hot key is
combined map-side); the business-side joins all use ``business_id``, so
each input is hash-partitioned once and the three joins share that
partitioning. The matrix join attaches the two feature tables to the
rating rows through ``join_dimension`` (size-checked broadcast or salted
shuffle join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starcast.functions import scalars as fn
from starcast.operators.joins import DEFAULT_BROADCAST_BYTES, join_dimension, materialize_all
from starcast.schemas import USER_COUNTERS

PAIR_KEYS = ["user_id", "business_id"]

BUSINESS_COLUMNS = ["b_latitude", "b_longitude", "b_stars", "b_review_count", "b_is_open",
                    "b_true_rate", "b_categories"]
BUSINESS_COUNTS = ["b_checkins", "b_photos", "b_tips"]
BUSINESS_FEATURES = BUSINESS_COLUMNS + BUSINESS_COUNTS
USER_COLUMNS = ["u_review_count", "u_since", "u_friends", "u_useful", "u_funny", "u_cool",
                "u_fans", "u_elite", "u_average_stars",
                *[f"u_{c}" for c in USER_COUNTERS if c.startswith("compliment_")]]
USER_COUNTS = ["u_tips"]
USER_FEATURES = USER_COLUMNS + USER_COUNTS
FEW_FEATURES = BUSINESS_FEATURES + USER_FEATURES  # 31 columns, model order


def dedupe_last(ratings: DataFrame, keys: list[str] = PAIR_KEYS, value: str = "stars",
                order: str = "order_key") -> DataFrame:
    """One row per pair: the value of the row with the greatest ``order``.

    ``max_by`` is a partial aggregate, so a pair repeated many times is
    reduced map-side before the shuffle.
    """
    return ratings.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per key (map-side combined)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def photo_counts(photo: DataFrame) -> DataFrame:
    return count_by(photo, "business_id", "n_photos")


def tips_by_business(tip: DataFrame) -> DataFrame:
    return count_by(tip, "business_id", "n_tips")


def tips_by_user(tip: DataFrame) -> DataFrame:
    return count_by(tip, "user_id", "n_tips")


def checkin_totals(checkin: DataFrame) -> DataFrame:
    """Total check-ins per business (sum of its time-slot map).

    Records of one business are summed, so a business listed twice counts
    once with both maps' totals.
    """
    return (checkin.select("business_id", fn.checkin_total("time").alias("t"))
            .groupBy("business_id").agg(F.sum("t").cast("bigint").alias("n_checkins")))


def business_projection(business: DataFrame) -> DataFrame:
    """business_id + 7 columns read from the business record."""
    return business.select(
        "business_id",
        fn.geo_default("latitude").alias("b_latitude"),
        fn.geo_default("longitude").alias("b_longitude"),
        F.col("stars").cast("double").alias("b_stars"),
        F.col("review_count").cast("bigint").alias("b_review_count"),
        F.col("is_open").cast("bigint").alias("b_is_open"),
        fn.true_attribute_rate("attributes").alias("b_true_rate"),
        fn.category_count("categories").cast("bigint").alias("b_categories"),
    )


def user_projection(user: DataFrame) -> DataFrame:
    """user_id + 20 columns read from the user record."""
    counters = {c: F.col(c).cast("bigint").alias(f"u_{c}") for c in USER_COUNTERS}
    return user.select(
        "user_id",
        F.col("review_count").cast("bigint").alias("u_review_count"),
        fn.since_epoch("yelping_since").alias("u_since"),
        fn.friend_count("friends").cast("bigint").alias("u_friends"),
        counters["useful"], counters["funny"], counters["cool"], counters["fans"],
        fn.elite_count("elite").cast("bigint").alias("u_elite"),
        F.col("average_stars").cast("double").alias("u_average_stars"),
        *[counters[c] for c in USER_COUNTERS if c.startswith("compliment_")],
    )


def _fill(c: str, fill: str) -> Column:
    if fill == "zero":
        return F.coalesce(F.col(c), F.lit(0)).alias(c)
    return F.col(c)


def business_features(business: DataFrame, checkin: DataFrame, photo: DataFrame, tip: DataFrame,
                      fill: str = "zero") -> DataFrame:
    """business_id + 10 features. ``fill='zero'`` turns a missing count into
    0 (narrow model); ``fill='null'`` keeps it missing (wide model)."""
    base = business_projection(business)
    joined = (base
              .join(checkin_totals(checkin).withColumnRenamed("n_checkins", "b_checkins"), "business_id", "left")
              .join(photo_counts(photo).withColumnRenamed("n_photos", "b_photos"), "business_id", "left")
              .join(tips_by_business(tip).withColumnRenamed("n_tips", "b_tips"), "business_id", "left"))
    return joined.select("business_id", *BUSINESS_COLUMNS, *[_fill(c, fill) for c in BUSINESS_COUNTS])


def user_features(user: DataFrame, tip: DataFrame, fill: str = "zero") -> DataFrame:
    """user_id + 21 features (20 projected + tips written)."""
    joined = user_projection(user).join(
        tips_by_user(tip).withColumnRenamed("n_tips", "u_tips"), "user_id", "left")
    return joined.select("user_id", *USER_COLUMNS, *[_fill(c, fill) for c in USER_COUNTS])


def feature_tables(business: DataFrame, checkin: DataFrame, photo: DataFrame, tip: DataFrame,
                   user: DataFrame, fill: str = "zero") -> tuple[DataFrame, int, DataFrame, int]:
    """Both feature tables, written once as Parquet into the shared folder
    (two concurrent jobs) and measured: ``(bfeat, bfeat_bytes, ufeat, ufeat_bytes)``. Train and test
    matrices then reuse them, and the measured sizes are the check that
    lets ``rating_features`` broadcast a table."""
    done = materialize_all({"bfeat": business_features(business, checkin, photo, tip, fill=fill),
                            "ufeat": user_features(user, tip, fill=fill)})
    (bfeat, _, bbytes), (ufeat, _, ubytes) = done["bfeat"], done["ufeat"]
    return bfeat, bbytes, ufeat, ubytes


def rating_features(pairs: DataFrame, bfeat: DataFrame, ufeat: DataFrame, *,
                    bfeat_bytes: int | None = None, ufeat_bytes: int | None = None,
                    hot: dict[str, DataFrame] | None = None,
                    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                    fill: str = "zero", keep: list[str] | None = None) -> DataFrame:
    """Pairs ⟕ business features ⟕ user features -> pair keys, ``keep``
    columns (e.g. stars), the 31 features and a ``cold_start`` flag.

    A pair whose business or user has no record keeps its row: features
    are filled (0 with ``fill='zero'``) and ``cold_start`` is true.
    ``*_bytes`` (from ``feature_tables``) allow a checked broadcast; ``hot``
    (from ``joins.hot_keys_by`` on the pairs) salts hot keys otherwise.
    """
    keep = keep or []
    hot = hot or {}
    b = bfeat.withColumn("_b_known", F.lit(True))
    u = ufeat.withColumn("_u_known", F.lit(True))
    left = pairs.select(*PAIR_KEYS, *keep)
    j = join_dimension(left, b, "business_id", dim_bytes=bfeat_bytes, hot=hot.get("business_id"),
                       broadcast_bytes=broadcast_bytes)
    j = join_dimension(j, u, "user_id", dim_bytes=ufeat_bytes, hot=hot.get("user_id"),
                       broadcast_bytes=broadcast_bytes)
    cold = F.col("_b_known").isNull() | F.col("_u_known").isNull()
    return j.select(*PAIR_KEYS, *keep, *[_fill(c, fill) for c in FEW_FEATURES], cold.alias("cold_start"))


def cold_start_pairs(pairs: DataFrame, bfeat: DataFrame, ufeat: DataFrame, *,
                     bfeat_bytes: int | None = None, ufeat_bytes: int | None = None,
                     hot: dict[str, DataFrame] | None = None) -> DataFrame:
    """Pairs whose business or user has no feature row, with which side is
    unknown (the reference fails on such pairs). ``*_bytes`` and ``hot`` as
    in ``rating_features``."""
    hot = hot or {}
    left = pairs.select(*PAIR_KEYS)
    b = bfeat.select("business_id", F.lit(True).alias("_b"))
    u = ufeat.select("user_id", F.lit(True).alias("_u"))
    j = join_dimension(left, b, "business_id", dim_bytes=bfeat_bytes, hot=hot.get("business_id"))
    j = join_dimension(j, u, "user_id", dim_bytes=ufeat_bytes, hot=hot.get("user_id"))
    return (j.where(F.col("_b").isNull() | F.col("_u").isNull())
            .select(*PAIR_KEYS, F.col("_b").isNull().alias("unknown_business"),
                    F.col("_u").isNull().alias("unknown_user")))


def labelled_features(features: DataFrame, labels: DataFrame, label: str = "stars") -> DataFrame:
    """Exact (user, business) lookup of the label for each feature row."""
    return features.join(labels.select(*PAIR_KEYS, label), PAIR_KEYS, "inner")
