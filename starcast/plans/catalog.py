"""Registry of named queries (one per operator) and their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over the benchmark tables;
``ORACLES[name]`` restates it in DuckDB SQL. Queries without an oracle
(model fitting) are checked by row count and invariants only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcast.functions import scalars as fn
from starcast.operators import evaluate as ev
from starcast.operators import features as ft
from starcast.operators import mlp as nn
from starcast.operators import scaling as sc_
from starcast.operators import scoring as scr
from starcast.operators import trees as tr
from starcast.operators import vocabulary as vb
from starcast.operators import wide as wd
from starcast.operators.joins import co_located, materialize_all, with_hot_keys, write_table
from starcast.plans.oracle import CTES, hash32_sql, with_ctes
from starcast.session import scratch_path
from starcast.sources import files as fl
from starcast.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn_: Query) -> Query:
        QUERIES[name] = fn_
        if sql is not None:
            ORACLES[name] = sql
        return fn_
    return deco


# --------------------------------------------------------------- shared inputs
def train_ratings(spark, d):
    return ft.dedupe_last(tb.raw_split(spark, d, validation=False))


def valid_ratings(spark, d):
    return ft.dedupe_last(tb.raw_split(spark, d, validation=True))


def both_ratings(spark, d):
    """Training and validation ratings of one pass over the line items, written:
    the joins below read them several times."""
    held = write_table(ft.dedupe_last(tb.raw_ratings(spark, d), [*ft.PAIR_KEYS, "is_validation"]), "ratings")
    return [held.where(F.col("is_validation") == F.lit(v)).drop("is_validation") for v in (False, True)]


def few_tables(spark, d, fill="zero"):
    e = tb.entities(spark, d)
    b = ft.business_features(e["business"], e["checkin"], e["photo"], e["tip"], fill=fill)
    u = ft.user_features(e["user"], e["tip"], fill=fill)
    return b, u


def matrix_tables(spark, d, fill="zero", extra: dict | None = None):
    """Feature tables written to the shared folder and measured (size-checked
    broadcast); ``extra`` tables are materialized in the same concurrent batch."""
    e = tb.entities(spark, d)
    tables = {"bfeat": ft.business_features(e["business"], e["checkin"], e["photo"], e["tip"], fill=fill),
              "ufeat": ft.user_features(e["user"], e["tip"], fill=fill), **(extra or {})}
    done = materialize_all(tables)
    sizes = dict(bfeat_bytes=done["bfeat"][2], ufeat_bytes=done["ufeat"][2])
    if extra:
        return done["bfeat"][0], done["ufeat"][0], sizes, {k: done[k] for k in extra}
    return done["bfeat"][0], done["ufeat"][0], sizes


def with_features(pairs: DataFrame, b, u, sizes: dict, written: bool = False, **options):
    """Pairs with their features; hot keys are salted where a feature table
    is too large to broadcast."""
    pairs, hot = with_hot_keys(pairs, dim_bytes=list(sizes.values()), written=written)
    return ft.rating_features(pairs, b, u, hot=hot, **sizes, **options)


def few_matrix(spark, d, ratings: DataFrame, fill="zero"):
    b, u, sizes = matrix_tables(spark, d, fill)
    return with_features(ratings, b, u, sizes, fill=fill, keep=["stars"])


def few_matrices(spark, d, fill="zero"):
    """Train and validation matrices over one set of feature tables."""
    b, u, sizes = matrix_tables(spark, d, fill)
    return tuple(with_features(r, b, u, sizes, written=True, fill=fill, keep=["stars"]).drop("cold_start")
                 for r in both_ratings(spark, d))


# ------------------------------------------------------------ scalar functions
@register("geo_default", with_ctes("""
    SELECT business_id, latitude, longitude, coalesce(latitude, 0.0) AS b_latitude,
           coalesce(longitude, 0.0) AS b_longitude FROM biz""", "biz"))
def q_geo_default(spark, d):
    b = tb.business(spark, d)
    return b.select("business_id", "latitude", "longitude",
                    fn.geo_default("latitude").alias("b_latitude"),
                    fn.geo_default("longitude").alias("b_longitude"))


@register("attribute_count", with_ctes("""
    SELECT business_id, CAST(CASE WHEN no_attributes THEN 0 ELSE 5 END AS BIGINT) AS n_attributes
    FROM biz""", "biz"))
def q_attribute_count(spark, d):
    b = tb.business(spark, d)
    return b.select("business_id", fn.attribute_count("attributes").cast("bigint").alias("n_attributes"))


@register("true_attribute_rate", with_ctes("SELECT business_id, b_true_rate FROM bproj", "bproj"))
def q_true_attribute_rate(spark, d):
    b = tb.business(spark, d)
    return b.select("business_id", fn.true_attribute_rate("attributes").alias("b_true_rate"))


@register("category_count", with_ctes("SELECT business_id, b_categories FROM bproj", "bproj"))
def q_category_count(spark, d):
    b = tb.business(spark, d)
    return b.select("business_id", fn.category_count("categories").cast("bigint").alias("b_categories"))


@register("checkin_total", with_ctes("SELECT business_id, n_checkins FROM checkins", "checkins"))
def q_checkin_total(spark, d):
    return ft.checkin_totals(tb.checkin(spark, d))


@register("since_epoch", with_ctes("SELECT user_id, yelping_since, u_since FROM uproj JOIN usr USING (user_id)",
                                   "uproj"))
def q_since_epoch(spark, d):
    u = tb.user(spark, d)
    return u.select("user_id", "yelping_since", fn.since_epoch("yelping_since").alias("u_since"))


@register("friend_count", with_ctes("SELECT user_id, friends, u_friends FROM uproj JOIN usr USING (user_id)",
                                    "uproj"))
def q_friend_count(spark, d):
    u = tb.user(spark, d)
    return u.select("user_id", "friends", fn.friend_count("friends").cast("bigint").alias("u_friends"))


@register("elite_count", with_ctes("SELECT user_id, elite, u_elite FROM uproj JOIN usr USING (user_id)",
                                   "uproj"))
def q_elite_count(spark, d):
    u = tb.user(spark, d)
    return u.select("user_id", "elite", fn.elite_count("elite").cast("bigint").alias("u_elite"))


_HOURS_SQL = """
    SELECT business_id, day, hours_text,
           CASE WHEN m < 0 THEN m + 24.0 ELSE m END AS hours
    FROM (SELECT business_id, day, hours_text,
                 ((CAST(split_part(split_part(hours_text, '-', 2), ':', 1) AS INT) * 60
                   + CAST(split_part(split_part(hours_text, '-', 2), ':', 2) AS INT))
                  - (CAST(split_part(split_part(hours_text, '-', 1), ':', 1) AS INT) * 60
                     + CAST(split_part(split_part(hours_text, '-', 1), ':', 2) AS INT))) / 60.0::DOUBLE AS m
          FROM (SELECT business_id, 'Monday' AS day, h_monday AS hours_text FROM biz
                UNION ALL SELECT business_id, 'Friday', h_friday FROM biz))"""


@register("opening_hours", with_ctes(_HOURS_SQL, "biz"))
def q_opening_hours(spark, d):
    b = tb.business(spark, d)
    return (b.select("business_id", F.explode("hours").alias("day", "hours_text"))
            .select("business_id", "day", "hours_text", fn.opening_hours("hours_text").alias("hours")))


@register("hash32", with_ctes(f"""
    SELECT p_partkey AS business_id, {hash32_sql('p_name')} AS name_hash,
           {hash32_sql('p_type')} AS type_hash, {hash32_sql('p_brand')} AS brand_hash FROM part"""))
def q_hash32(spark, d):
    p = tb.table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("business_id"), fn.hash32("p_name").alias("name_hash"),
                    fn.hash32("p_type").alias("type_hash"), fn.hash32("p_brand").alias("brand_hash"))


_FLAT_ATTRS_SQL = """
    SELECT business_id, attribute, raw,
           CASE WHEN raw = 'True' THEN 1.0 WHEN raw = 'False' THEN 0.0
                ELSE CAST({h} AS DOUBLE) END AS value
    FROM (SELECT business_id, 'small' AS attribute, a_small AS raw FROM biz WHERE NOT no_attributes
          UNION ALL SELECT business_id, 'metal', a_metal FROM biz WHERE NOT no_attributes
          UNION ALL SELECT business_id, 'kind', a_kind FROM biz WHERE NOT no_attributes
          UNION ALL SELECT business_id, 'price', a_price FROM biz WHERE NOT no_attributes)"""


@register("encode_value", with_ctes(_FLAT_ATTRS_SQL.format(h=hash32_sql("raw")), "biz"))
def q_encode_value(spark, d):
    b = tb.business(spark, d)
    kv = b.select("business_id", F.explode("attributes").alias("attribute", "raw"))
    return (kv.where(~fn.is_dict_literal("raw"))
            .select("business_id", "attribute", "raw", fn.encode_text("raw").alias("value")))


_NESTED_SQL = """
    SELECT business_id, 'parking' AS attribute, key, raw FROM (
        SELECT business_id, 'garage' AS key, k_garage AS raw FROM biz WHERE NOT no_attributes
        UNION ALL SELECT business_id, 'lot', k_lot FROM biz WHERE NOT no_attributes
        UNION ALL SELECT business_id, 'valet', 'None' FROM biz WHERE NOT no_attributes)"""


@register("parse_dict_literal", with_ctes(_NESTED_SQL, "biz"))
def q_parse_dict_literal(spark, d):
    b = tb.business(spark, d)
    kv = b.select("business_id", F.explode("attributes").alias("attribute", "text"))
    return (kv.where(fn.is_dict_literal("text"))
            .select("business_id", "attribute", F.explode(fn.parse_dict_literal("text")).alias("key", "raw")))


@register("category_tokens", with_ctes("""
    SELECT business_id, trim(token) AS token
    FROM (SELECT business_id, unnest(string_split(categories, ',')) AS token FROM biz
          WHERE categories IS NOT NULL)""", "biz"))
def q_category_tokens(spark, d):
    b = tb.business(spark, d)
    return b.select("business_id", F.explode(F.transform(F.split("categories", ","), fn.strip)).alias("token"))


@register("clip_rating", with_ctes("""
    SELECT v.user_id, v.business_id, im + um - 3.0 AS raw,
           least(greatest(im + um - 3.0, 1.0), 5.0) AS prediction
    FROM valid v JOIN item_mean i ON v.business_id = i.business_id
         JOIN user_mean u ON v.user_id = u.user_id""", "valid", "item_mean", "user_mean"))
def q_clip_rating(spark, d):
    train, valid = train_ratings(spark, d), valid_ratings(spark, d)
    item = train.groupBy("business_id").agg(F.avg("stars").alias("_im"))
    usr = train.groupBy("user_id").agg(F.avg("stars").alias("_um"))
    raw = F.col("_im") + F.col("_um") - F.lit(3.0)
    return (valid.join(item, "business_id").join(usr, "user_id")
            .select("user_id", "business_id", raw.alias("raw"), fn.clip_rating(raw).alias("prediction")))


# ------------------------------------------------- projections, counts, joins
@register("business_projection", with_ctes("SELECT * FROM bproj", "bproj"))
def q_business_projection(spark, d):
    return ft.business_projection(tb.business(spark, d))


@register("user_projection", with_ctes("SELECT * FROM uproj", "uproj"))
def q_user_projection(spark, d):
    return ft.user_projection(tb.user(spark, d))


@register("dedupe_last", with_ctes("SELECT * FROM ratings", "ratings"))
def q_dedupe_last(spark, d):
    return ft.dedupe_last(tb.raw_ratings(spark, d))


@register("photo_counts", with_ctes("SELECT * FROM photos", "photos"))
def q_photo_counts(spark, d):
    return ft.photo_counts(tb.photo(spark, d))


@register("tips_by_business", with_ctes("SELECT * FROM btips", "btips"))
def q_tips_by_business(spark, d):
    return ft.tips_by_business(tb.tip(spark, d))


@register("tips_by_user", with_ctes("SELECT * FROM utips", "utips"))
def q_tips_by_user(spark, d):
    return ft.tips_by_user(tb.tip(spark, d))


@register("business_features", with_ctes("SELECT * FROM bfeat", "bfeat"))
def q_business_features(spark, d):
    return few_tables(spark, d)[0]


@register("user_features", with_ctes("SELECT * FROM ufeat", "ufeat"))
def q_user_features(spark, d):
    return few_tables(spark, d)[1]


_MATRIX_ALL = with_ctes(f"""
    SELECT r.user_id, r.business_id, r.stars,
           {", ".join(f"coalesce({c}, 0) AS {c}" for c in ft.FEW_FEATURES)},
           (b.business_id IS NULL OR u.user_id IS NULL) AS cold_start
    FROM ratings r LEFT JOIN bfeat b ON r.business_id = b.business_id
         LEFT JOIN ufeat u ON r.user_id = u.user_id""", "ratings", "bfeat", "ufeat")


@register("rating_features", _MATRIX_ALL)
def q_rating_features(spark, d):
    ratings = ft.dedupe_last(tb.raw_ratings(spark, d))
    return few_matrix(spark, d, ratings)


@register("pair_features", with_ctes(f"""
    SELECT v.user_id, v.business_id,
           {", ".join(f"coalesce({c}, 0) AS {c}" for c in ft.FEW_FEATURES)},
           (b.business_id IS NULL OR u.user_id IS NULL) AS cold_start
    FROM (SELECT DISTINCT user_id, business_id FROM raw_ratings WHERE is_validation) v
         LEFT JOIN bfeat b ON v.business_id = b.business_id
         LEFT JOIN ufeat u ON v.user_id = u.user_id""", "raw_ratings", "bfeat", "ufeat"))
def q_pair_features(spark, d):
    pairs = tb.raw_split(spark, d, validation=True).select(*ft.PAIR_KEYS).distinct()
    b, u, sizes = matrix_tables(spark, d)
    return with_features(pairs, b, u, sizes)


@register("cold_start_pairs", with_ctes("""
    SELECT r.user_id, r.business_id, b.business_id IS NULL AS unknown_business,
           u.user_id IS NULL AS unknown_user
    FROM (SELECT user_id + 11 AS user_id, business_id + 7 AS business_id FROM ratings) r
         LEFT JOIN bfeat b ON r.business_id = b.business_id
         LEFT JOIN ufeat u ON r.user_id = u.user_id
    WHERE b.business_id IS NULL OR u.user_id IS NULL""", "ratings", "bfeat", "ufeat"))
def q_cold_start_pairs(spark, d):
    """The rated pairs with shifted ids, so that some have no record."""
    b, u, rows = matrix_tables(spark, d)
    pairs = ft.dedupe_last(tb.raw_ratings(spark, d)).select(
        (F.col("user_id") + 11).alias("user_id"), (F.col("business_id") + 7).alias("business_id"))
    return ft.cold_start_pairs(pairs, b, u, **rows)


@register("labelled_features", with_ctes("SELECT * FROM train_matrix", "train_matrix"))
def q_labelled_features(spark, d):
    """The label is looked up while the rows are still pairs, so that the
    lookup moves no features."""
    labels, _ = both_ratings(spark, d)
    pairs = labels.select(*ft.PAIR_KEYS).distinct()
    b, u, sizes = matrix_tables(spark, d)
    labelled = ft.labelled_features(pairs, labels)
    return with_features(labelled, b, u, sizes, keep=["stars"]).select(*ft.PAIR_KEYS, *ft.FEW_FEATURES, "stars")


@register("matrix_shape", with_ctes("""
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(31 AS BIGINT) AS n_columns FROM ratings""", "ratings"))
def q_matrix_shape(spark, d):
    m = q_rating_features(spark, d)
    return m.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(ft.FEW_FEATURES)).cast("bigint").alias("n_columns"))


# ------------------------------------------------------------------ evaluation
@register("rmse", with_ctes("""
    SELECT CAST(count(p) AS BIGINT) AS n, CAST(sum(CASE WHEN p IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
           round(sqrt(avg(power(y - p, 2))), 9) AS rmse,
           round(sqrt(avg(power(y - p, 2))) * 10000, 5) AS rmse_x10k
    FROM scored""", "scored"))
def q_rmse(spark, d):
    valid = valid_ratings(spark, d)
    return ev.rmse(valid, ev.baseline_predictions(train_ratings(spark, d), valid))


@register("rmse_evaluator", with_ctes("""
    SELECT round(sqrt(avg(power(y - p, 2))), 9) AS rmse FROM scored WHERE p IS NOT NULL""", "scored"))
def q_rmse_evaluator(spark, d):
    valid = valid_ratings(spark, d)
    return ev.rmse_evaluator(valid, ev.baseline_predictions(train_ratings(spark, d), valid))


@register("error_distribution", with_ctes("""
    SELECT CAST(b.bucket AS BIGINT) AS bucket, CAST(b.bucket AS DOUBLE) AS lower,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM range(5) b(bucket) LEFT JOIN (
        SELECT least(floor(abs(y - p)), 4) AS bucket, count(*) AS n FROM scored
        WHERE p IS NOT NULL GROUP BY 1) c ON b.bucket = c.bucket""", "scored"))
def q_error_distribution(spark, d):
    valid = valid_ratings(spark, d)
    return ev.error_distribution(valid, ev.baseline_predictions(train_ratings(spark, d), valid))


@register("missing_predictions", with_ctes("""
    SELECT user_id, business_id FROM scored WHERE p IS NULL""", "scored"))
def q_missing_predictions(spark, d):
    valid = valid_ratings(spark, d)
    return ev.missing_predictions(valid, ev.baseline_predictions(train_ratings(spark, d), valid))


# ------------------------------------------------------- wide feature path


def wide_long(spark, d):
    return vb.wide_features_long(tb.business(spark, d, spread_rows=True))


@register("wide_features_long", with_ctes("SELECT * FROM wide_long", "wide_long"))
def q_wide_features_long(spark, d):
    return wide_long(spark, d)


@register("flatten_paths", with_ctes("""
    SELECT business_id, feature FROM wide_long WHERE kind IN ('attribute', 'hours')""", "wide_long"))
def q_flatten_paths(spark, d):
    return vb.flatten_paths(tb.business(spark, d, spread_rows=True))


@register("feature_vocabulary", with_ctes("SELECT * FROM vocab", "vocab"))
def q_feature_vocabulary(spark, d):
    return vb.feature_vocabulary(wide_long(spark, d))


@register("feature_values", with_ctes("SELECT DISTINCT feature, raw, value FROM wide_long", "wide_long"))
def q_feature_values(spark, d):
    return vb.feature_values(wide_long(spark, d))


@register("feature_index", with_ctes("""
    SELECT feature, kind, CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS idx FROM vocab""",
                                     "vocab"))
def q_feature_index(spark, d):
    return vb.feature_index(vb.feature_vocabulary(wide_long(spark, d)))


def wide_inputs(spark, d):
    """Business cells with counts, user features (both written and measured),
    the vocabulary's width and its zero slots."""
    business = tb.business(spark, d, spread_rows=True)
    index = write_table(vb.feature_index(vb.feature_vocabulary(vb.wide_features_long(business))), "wide-index")
    width = index.count()
    e = tb.entities(spark, d)
    counts = ft.business_features(e["business"], e["checkin"], e["photo"], e["tip"], fill="null")
    done = materialize_all({"cells": wd.with_counts(wd.business_cells(business, index), counts, width),
                            "ufeat": ft.user_features(e["user"], e["tip"], fill="null")})
    cells = wd.check_unknown(done["cells"][0])
    sizes = dict(cells_bytes=wd.cells_bytes(cells), ufeat_bytes=done["ufeat"][2])
    return (co_located(cells, "business_id", sizes["cells_bytes"], name="wide-cells"),
            co_located(done["ufeat"][0], "user_id", sizes["ufeat_bytes"], name="user-features"), width, index, sizes)


def wide_matrices(spark, d):
    """Wide training and validation matrices and the vocabulary index."""
    cells, users, width, index, sizes = wide_inputs(spark, d)
    return [wd.wide_matrix(r, cells, users, width, keep=["stars"], **sizes) for r in both_ratings(spark, d)] + [index]


_WIDE_SET_SQL = with_ctes(f"""
    SELECT t.user_id, t.business_id, t.stars,
           CAST((SELECT count(*) FROM vocab) + 24 AS INTEGER) AS width,
           CAST(coalesce(k.n, 0)
                + {" + ".join(f"(b.{c} IS NOT NULL)::INT" for c in ft.BUSINESS_COUNTS)}
                + {" + ".join(f"(u.{c} IS NOT NULL)::INT" for c in ft.USER_FEATURES)} AS INTEGER) AS n_set
    FROM train t
    LEFT JOIN (SELECT business_id, count(DISTINCT feature) AS n FROM wide_long
               WHERE value IS NOT NULL GROUP BY business_id) k ON t.business_id = k.business_id
    LEFT JOIN bfeat_null b ON t.business_id = b.business_id
    LEFT JOIN ufeat_null u ON t.user_id = u.user_id""", "train", "wide_long", "vocab", "bfeat_null", "ufeat_null")


@register("assemble_wide", _WIDE_SET_SQL)
def q_assemble_wide(spark, d):
    """Wide training matrix: width and cells that hold a value per row."""
    train, _, index = wide_matrices(spark, d)
    width = index.count() + wd.EXTRA
    return train.select("user_id", "business_id", "stars", F.lit(width).alias("width"), wd.present().alias("n_set"))


@register("fill_missing_marker", with_ctes(f"""
    SELECT r.user_id, r.business_id, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ft.FEW_FEATURES)},
           CAST({" + ".join(f"({c} IS NULL)::INT" for c in ft.FEW_FEATURES)} AS INTEGER) AS n_missing
    FROM ratings r LEFT JOIN bfeat_null b ON r.business_id = b.business_id
         LEFT JOIN ufeat_null u ON r.user_id = u.user_id""", "ratings", "bfeat_null", "ufeat_null"))
def q_fill_missing_marker(spark, d):
    """The matrix as the tree learner gets it: a missing value stays null
    (bin 0 of ``operators.boosting``), no number stands in for it."""
    m = few_matrix(spark, d, ft.dedupe_last(tb.raw_ratings(spark, d)), fill="null")
    missing = sum((F.col(c).isNull().cast("int") for c in ft.FEW_FEATURES), F.lit(0))
    return m.select("user_id", "business_id", *[F.col(c).cast("double").alias(c) for c in ft.FEW_FEATURES],
                    missing.alias("n_missing"))


@register("fill_missing_zero", with_ctes(f"""
    SELECT business_id, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ft.BUSINESS_FEATURES)}
    FROM bfeat_null""", "bfeat_null"))
def q_fill_missing_zero(spark, d):
    b, _ = few_tables(spark, d, fill="null")
    return b.fillna(0)


# ------------------------------------------------------------- file formats


def _as_text_ids(df):
    return df.select(*[F.col(c).cast("string").alias(c) if c in ft.PAIR_KEYS else F.col(c) for c in df.columns])


@register("read_ratings_csv", with_ctes("""
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, stars
    FROM train""", "train"))
def q_read_ratings_csv(spark, d):
    path = fl.write_ratings_csv(train_ratings(spark, d), scratch_path(spark, "ratings-csv"))
    return fl.read_ratings_csv(spark, path)


@register("read_pairs_csv", with_ctes("""
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id
    FROM valid""", "valid"))
def q_read_pairs_csv(spark, d):
    path = fl.write_ratings_csv(valid_ratings(spark, d), scratch_path(spark, "pairs-csv"))
    return fl.read_pairs_csv(spark, path)


def _json_roundtrip(spark, d):
    out = {}
    for name, df in tb.entities(spark, d).items():
        path = fl.write_json_lines(_as_text_ids(df), scratch_path(spark, f"{name}-json"))
        out[name] = fl.read_json_lines(spark, path, name)
    return out


@register("read_json_lines", with_ctes("""
    SELECT CAST(business_id AS VARCHAR) AS business_id, * EXCLUDE (business_id) FROM bfeat""", "bfeat"))
def q_read_json_lines(spark, d):
    e = _json_roundtrip(spark, d)
    return ft.business_features(e["business"], e["checkin"], e["photo"], e["tip"])


@register("read_json_users", with_ctes("""
    SELECT CAST(user_id AS VARCHAR) AS user_id, * EXCLUDE (user_id) FROM ufeat""", "ufeat"))
def q_read_json_users(spark, d):
    e = _json_roundtrip(spark, d)
    return ft.user_features(e["user"], e["tip"])


@register("predictions_roundtrip", with_ctes("""
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id, prediction
    FROM baseline""", "baseline"))
def q_predictions_roundtrip(spark, d):
    valid = valid_ratings(spark, d)
    pred = ev.baseline_predictions(train_ratings(spark, d), valid)
    path = fl.write_predictions_csv(pred, scratch_path(spark, "predictions-csv"))
    return fl.read_predictions_csv(spark, path)


# ----------------------------------------------------------------- scaling


def _minmax_sql(src: str, stats_src: str) -> str:
    cols = ft.FEW_FEATURES
    stats = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in cols)
    scaled = ", ".join(
        f"(CAST(m.{c} AS DOUBLE) - s.lo_{c}) / CASE WHEN s.hi_{c} = s.lo_{c} THEN 1.0 "
        f"ELSE CAST(s.hi_{c} - s.lo_{c} AS DOUBLE) END AS {c}" for c in cols)
    return (f"SELECT m.user_id, m.business_id, m.stars, {scaled} FROM {src} m, "
            f"(SELECT {stats} FROM {stats_src}) s")


@register("minmax_stats", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS fmin, CAST(max({c}) AS DOUBLE) AS fmax "
    f"FROM train_matrix" for c in ft.FEW_FEATURES), "train_matrix"))
def q_minmax_stats(spark, d):
    return sc_.minmax_stats(few_matrix(spark, d, train_ratings(spark, d)), ft.FEW_FEATURES)


@register("minmax_scale", with_ctes(_minmax_sql("valid_matrix", "train_matrix"), "valid_matrix", "train_matrix"))
def q_minmax_scale(spark, d):
    train, valid = few_matrices(spark, d)
    return sc_.minmax_scale(valid, ft.FEW_FEATURES, sc_.minmax_fit(train, ft.FEW_FEATURES))


@register("minmax_scale_refit", with_ctes(_minmax_sql("valid_matrix", "valid_matrix"), "valid_matrix"))
def q_minmax_scale_refit(spark, d):
    valid = few_matrix(spark, d, valid_ratings(spark, d)).drop("cold_start")
    return sc_.minmax_scale(valid, ft.FEW_FEATURES, refit=True)


# ------------------------------------------------------------------ models


# Tree and epoch counts of the registered model queries: the reference's.
QUERY_TREES = tr.FEW_TREE_PARAMS["n_estimators"]
QUERY_WIDE_TREES = tr.WIDE_TREE_PARAMS["n_estimators"]
QUERY_EPOCHS = 20
QUERY_WIDE_EPOCHS = 10

CTES["signal_valid"] = (["valid_matrix"], """
    SELECT user_id, business_id, least(greatest(0.5 * b_stars + 0.3 * u_average_stars, 1.0), 5.0) AS y
    FROM valid_matrix""")
CTES["signal_train"] = (["train_matrix"], """
    SELECT least(greatest(0.5 * b_stars + 0.3 * u_average_stars, 1.0), 5.0) AS y FROM train_matrix""")

# Fits are checked by what must hold of any sound one: every pair scored,
# within the range, closer to the label than the training mean is.
MODEL_SQL = with_ctes("""
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_range,
           round(sqrt(avg(power(y - m, 2))), 6) AS mean_rmse, true AS beats_mean
    FROM signal_valid, (SELECT avg(y) AS m FROM signal_train)""", "signal_valid", "signal_train")

CTES["valid_scaled"] = (["valid_matrix", "train_matrix"], _minmax_sql("valid_matrix", "train_matrix"))


def linear_weights(n: int) -> tuple[list[float], float]:
    """Fixed linear model used to check partition-wise scoring."""
    return [((i * 7) % 11 - 5) / 10.0 for i in range(n)], 3.0


def mlp_fixed_params(n_in: int, hidden: int = 8) -> list[np.ndarray]:
    """Fixed two-layer network used to check the forward pass."""
    w1 = np.array([[((i * 3 + j * 5) % 7 - 3) / 10.0 for j in range(hidden)] for i in range(n_in)])
    b1 = np.array([(j % 3 - 1) / 10.0 for j in range(hidden)])
    w2 = np.array([[((j * 5) % 9 - 4) / 10.0] for j in range(hidden)])
    return [w1, b1, w2, np.array([3.0])]


def _linear_sql() -> str:
    w, b = linear_weights(len(ft.FEW_FEATURES))
    terms = " + ".join(f"({wi})::DOUBLE * {c}" for wi, c in zip(w, ft.FEW_FEATURES))
    return with_ctes(f"""
        SELECT user_id, business_id, round({b}::DOUBLE + {terms}, 9) AS raw,
               least(greatest(round({b}::DOUBLE + {terms}, 9), 1.0), 5.0) AS prediction
        FROM valid_scaled""", "valid_scaled")


def _mlp_sql() -> str:
    w1, b1, w2, b2 = mlp_fixed_params(len(ft.FEW_FEATURES))
    hidden = []
    for j in range(w1.shape[1]):
        terms = " + ".join(f"({w1[i, j]})::DOUBLE * {c}" for i, c in enumerate(ft.FEW_FEATURES))
        hidden.append(f"greatest(({b1[j]})::DOUBLE + {terms}, 0.0) AS h{j}")
    out = " + ".join(f"({w2[j, 0]})::DOUBLE * h{j}" for j in range(w1.shape[1]))
    return with_ctes(f"""
        SELECT user_id, business_id, round(({b2[0]})::DOUBLE + {out}, 9) AS prediction
        FROM (SELECT user_id, business_id, {", ".join(hidden)} FROM valid_scaled)""", "valid_scaled")


def scaled_few(spark, d):
    train, valid = few_matrices(spark, d)
    stats = sc_.minmax_fit(train, ft.FEW_FEATURES)
    return sc_.minmax_scale(train, ft.FEW_FEATURES, stats), sc_.minmax_scale(valid, ft.FEW_FEATURES, stats)


@register("score_partitions", _linear_sql())
def q_score_partitions(spark, d):
    _, valid = scaled_few(spark, d)
    w, b = linear_weights(len(ft.FEW_FEATURES))
    raw = scr.score_partitions(valid, scr.LinearModel(w, b), ft.FEW_FEATURES)
    r = F.round("raw", 9)
    return raw.select("user_id", "business_id", r.alias("raw"), fn.clip_rating(r).alias("prediction"))


@register("mlp_score", _mlp_sql())
def q_mlp_score(spark, d):
    from pyspark.ml.functions import array_to_vector

    _, valid = scaled_few(spark, d)
    params = mlp_fixed_params(len(ft.FEW_FEATURES))
    vec = valid.select("user_id", "business_id", array_to_vector(F.array(*ft.FEW_FEATURES)).alias("features"))
    layers = [len(ft.FEW_FEATURES), params[0].shape[1], 1]
    out = nn.score_mlp(vec, nn.flatten(params), layers)
    return out.select("user_id", "business_id", F.round("prediction", 9).alias("prediction"))


def few_model_inputs(spark, d):
    return few_matrices(spark, d)


def signal(b_stars, u_average_stars):
    """Label of the model queries: a function of two features, so that a fit
    has something to learn (the tables' own stars are noise)."""
    return fn.clip_rating(F.lit(0.5) * b_stars + F.lit(0.3) * u_average_stars)


def signal_matrices(spark, d):
    """Train and validation matrices with the signal label, written."""
    label = signal(F.col("b_stars"), F.col("u_average_stars"))
    return [write_table(m.withColumn("stars", label), "signal-matrix") for m in few_matrices(spark, d)]


def signal_wide_matrices(spark, d):
    """The wide matrices with the signal label, written, and the index."""
    b = tb.business(spark, d).select("business_id", F.col("stars").alias("_b"))
    u = tb.user(spark, d).select("user_id", F.col("average_stars").alias("_u"))
    out = []
    *matrices, index = wide_matrices(spark, d)
    for m in matrices:
        m = m.drop("stars").join(b, "business_id", "left").join(u, "user_id", "left")
        label = signal(F.coalesce("_b", F.lit(0.0)), F.coalesce("_u", F.lit(0.0)))
        out.append(write_table(m.withColumn("stars", label).select(*ft.PAIR_KEYS, "stars", "features"), "signal-wide"))
    return [*out, index]


def model_summary(predictions, train, valid):
    """One row of invariants of a fit (see ``MODEL_SQL``)."""
    mean = train.agg(F.avg("stars")).first()[0]
    rows = valid.select(*ft.PAIR_KEYS, "stars").join(predictions.select(*ft.PAIR_KEYS, "prediction"), ft.PAIR_KEYS)
    base = F.sqrt(F.avg(F.pow(F.col("stars") - F.lit(mean), 2)))
    fitted = F.sqrt(F.avg(F.pow(F.col("stars") - F.col("prediction"), 2)))
    return rows.agg(F.count("prediction").alias("n_rows"),
                    F.count(F.when(~F.col("prediction").between(1.0, 5.0), 1)).alias("n_out_of_range"),
                    F.round(base, 6).alias("mean_rmse"), (fitted < base).alias("beats_mean"))


def _vector_shape(df, col="features"):
    """Per row: vector width and number of non-zero slots."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(F.col(col))
    return df.select("user_id", "business_id", "stars", F.size(arr).alias("width"),
                     F.size(F.filter(arr, lambda x: x != 0)).alias("n_set"))


@register("assemble_few", with_ctes(f"""
    SELECT user_id, business_id, stars, CAST(31 AS INTEGER) AS width,
           CAST({" + ".join(f"({c} <> 0)::INT" for c in ft.FEW_FEATURES)} AS INTEGER) AS n_set
    FROM train_matrix""", "train_matrix"))
def q_assemble_few(spark, d):
    from pyspark.ml.feature import VectorAssembler

    train, _ = few_model_inputs(spark, d)
    return _vector_shape(VectorAssembler(inputCols=ft.FEW_FEATURES, outputCol="features").transform(train))


_FITTED: dict[tuple, str] = {}  # models written by this application


def _few_trees(spark, d, again: bool = False):
    """The narrow fit, its training and validation rows. Queries that only use
    a model share the one written by the first of them; ``again`` fits."""
    key = (spark.sparkContext.applicationId, d)
    train, valid = signal_matrices(spark, d)
    if again or key not in _FITTED:
        model = tr.fit_few(train, n_estimators=QUERY_TREES, written=True)
        _FITTED[key] = tr.save_model(model, scratch_path(spark, "gbt-few-model"), spark)
        return model, train, valid
    return tr.load_model(_FITTED[key], spark), train, valid


@register("gbt_few", MODEL_SQL)
def q_gbt_few(spark, d):
    model, train, valid = _few_trees(spark, d, again=True)
    return model_summary(tr.predict_clip(model, valid), train, valid)


@register("predict_clip", with_ctes("""
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_wrong FROM valid""", "valid"))
def q_predict_clip(spark, d):
    """Pairs scored in partitions, and those whose prediction is not the
    clipped raw value."""
    model, _, valid = _few_trees(spark, d)
    out = tr.predict(model, valid.drop("stars")).select(F.col("prediction").alias("raw"),
                                                        fn.clip_rating("prediction").alias("prediction"))
    low, high = F.col("raw") < 1, F.col("raw") > 5
    wanted = F.when(low, 1.0).when(high, 5.0).otherwise(F.col("raw"))
    return out.agg(F.count("raw").alias("n_rows"), F.count(F.when(F.col("prediction") != wanted, 1)).alias("n_wrong"))


@register("model_roundtrip", with_ctes("""
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS DOUBLE) AS max_difference FROM valid""", "valid"))
def q_model_roundtrip(spark, d):
    """Pairs scored by a model and by its saved and loaded copy, and the largest difference."""
    model, _, valid = _few_trees(spark, d)
    path = tr.save_model(model, scratch_path(spark, "gbt-few-copy"), spark)
    again = tr.predict_clip(tr.load_model(path, spark), valid).withColumnRenamed("prediction", "loaded")
    both = tr.predict_clip(model, valid).join(again, ft.PAIR_KEYS)
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.max(F.abs(F.col("prediction") - F.col("loaded"))).alias("max_difference"))


@register("tune_trees", f"""
    SELECT CAST(n AS INTEGER) AS n_trees, true AS beats_mean FROM (VALUES {", ".join(f"({n})" for n in tr.TUNED_TREES)}) t(n)""")
def q_tune_trees(spark, d):
    train, _ = signal_matrices(spark, d)
    spread = train.agg(F.stddev_pop("stars")).first()[0]
    _, table = tr.tune_trees(train)
    return table.select("n_trees", (F.col("rmse") < F.lit(spread)).alias("beats_mean"))


@register("gbt_wide", MODEL_SQL)
def q_gbt_wide(spark, d):
    train, valid, index = signal_wide_matrices(spark, d)
    model = tr.fit_wide(train, wd.zero_slots(index), n_estimators=QUERY_WIDE_TREES, written=True)
    return model_summary(tr.predict_clip(model, valid), train, valid)


def _mlp_few(spark, d, epochs):
    from pyspark.ml.functions import array_to_vector

    train, valid = signal_matrices(spark, d)
    stats = sc_.minmax_fit(train, ft.FEW_FEATURES)
    train, valid = (sc_.minmax_scale(m, ft.FEW_FEATURES, stats) for m in (train, valid))
    vec = lambda df: df.select("user_id", "business_id", "stars",
                               array_to_vector(F.array(*ft.FEW_FEATURES)).alias("features"))
    tv, vv = vec(train), vec(valid)
    flat, hist = nn.fit_mlp(tv, nn.FEW_LAYERS, epochs=epochs, validation=vv, seed=1)
    return flat, hist, tv, vv


def clipped(predictions):
    return predictions.withColumn("prediction", fn.clip_rating("prediction"))


@register("mlp_fit_few", MODEL_SQL)
def q_mlp_fit_few(spark, d):
    flat, _, tv, vv = _mlp_few(spark, d, QUERY_EPOCHS)
    return model_summary(clipped(nn.score_mlp(vv, flat, nn.FEW_LAYERS)), tv, vv)


@register("mlp_loss_curve", f"""
    SELECT CAST(range AS INTEGER) AS epoch, true AS falling FROM range(1, {QUERY_EPOCHS + 1})""")
def q_mlp_loss_curve(spark, d):
    """Per epoch: whether both losses are at most the first epoch's."""
    _, hist, _, _ = _mlp_few(spark, d, QUERY_EPOCHS)
    rows = [(n, train <= hist[0][1] and valid <= hist[0][2]) for n, train, valid in hist]
    return spark.createDataFrame(rows, "epoch int, falling boolean")


@register("mlp_fit_wide", MODEL_SQL)
def q_mlp_fit_wide(spark, d):
    train, valid, index = signal_wide_matrices(spark, d)
    width = index.count() + wd.EXTRA
    stats = sc_.sparse_minmax_fit(train, width)   # training min/max, applied to both
    layers = [width] + nn.WIDE_LAYERS[1:]
    flat, _ = nn.fit_mlp(train, layers, epochs=QUERY_WIDE_EPOCHS, validation=valid, seed=1, scale=stats)
    return model_summary(clipped(nn.score_mlp(valid, flat, layers, scale=stats)), train, valid)


# ------------------------------------------------------- text sinks, shapes
@register("write_feature_list", with_ctes("SELECT feature AS value FROM vocab", "vocab"))
def q_write_feature_list(spark, d):
    path = fl.write_feature_list(vb.feature_vocabulary(wide_long(spark, d)), scratch_path(spark, "features"))
    return spark.read.text(path)


@register("write_feature_values", with_ctes("""
    SELECT feature || ' : [' || string_agg(v, ', ' ORDER BY v) || ']' AS value
    FROM (SELECT DISTINCT feature, coalesce(raw, CAST(value AS VARCHAR), 'None') AS v FROM wide_long)
    GROUP BY feature""", "wide_long"))
def q_write_feature_values(spark, d):
    path = fl.write_feature_values(vb.feature_values(wide_long(spark, d)), scratch_path(spark, "feature-values"))
    return spark.read.text(path)


@register("wide_matrix_shape", with_ctes("""
    SELECT CAST((SELECT count(*) FROM train) AS BIGINT) AS n_rows,
           CAST((SELECT count(*) FROM vocab) + 24 AS INTEGER) AS n_columns""", "train", "vocab"))
def q_wide_matrix_shape(spark, d):
    train, _, index = wide_matrices(spark, d)
    # no cell lies beyond the width, and the last slot is held
    last = F.max(F.array_max("features.slots")) + 1
    return train.agg(F.count(F.lit(1)).alias("n_rows"), F.greatest(last, F.lit(index.count() + wd.EXTRA)).alias("n_columns"))


def _undeclared_json(spark, d):
    """The parts as business records with keys that no schema declares."""
    p = tb.table(spark, d, "part")
    rows = p.select(F.col("p_partkey").cast("string").alias("business_id"), F.col("p_type").alias("kind_text"),
                    F.col("p_size").alias("size_number"), (F.col("p_size") > 25).alias("large"), F.array("p_brand").alias("tags"),
                    F.create_map(F.lit("flag"), F.when(F.col("p_size") % 2 == 0, "True").otherwise("False"),
                                 F.lit("nested"), F.concat(F.lit("{'size': "), F.col("p_size").cast("string"), F.lit("}"))).alias("more"))
    path = scratch_path(spark, "undeclared-json")
    rows.write.json(path)
    return fl.read_business(spark, path)


@register("undeclared_keys", """
    WITH f AS (
        SELECT 'kind_text' AS feature, CAST(NULL AS DOUBLE) AS value FROM part
        UNION ALL SELECT 'size_number', p_size FROM part
        UNION ALL SELECT 'large', (p_size > 25)::INT FROM part
        UNION ALL SELECT 'tags', NULL FROM part
        UNION ALL SELECT 'more$flag', (p_size % 2 = 0)::INT FROM part
        UNION ALL SELECT 'more$nested$size', p_size FROM part)
    SELECT feature, CAST(count(*) AS BIGINT) AS n_records, CAST(sum(value) AS DOUBLE) AS total FROM f GROUP BY feature""")
def q_undeclared_keys(spark, d):
    """Features of business keys outside the schema: records and sum of values
    (texts, encoded by a hash, are left out of the sum)."""
    long = vb.wide_features_long(_undeclared_json(spark, d).select("business_id", vb.EXTRA_COLUMN))
    value = F.when(F.col("feature") != "kind_text", F.col("value"))
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("n_records"), F.sum(value).alias("total"))
