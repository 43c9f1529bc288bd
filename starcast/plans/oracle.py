"""DuckDB SQL that restates each registered query independently.

The entities are derived from the benchmark tables with the same value
rules as ``starcast.sources.tables`` (the shared input definition); the
operators themselves (dedupe, counts, joins, parsing, metrics) are written
from their definitions in plain SQL.
"""

from __future__ import annotations

from starcast.operators.features import BUSINESS_FEATURES, FEW_FEATURES, USER_FEATURES
from starcast.schemas import USER_COUNTERS

FLAG = "CASE WHEN {c} THEN 'True' ELSE 'False' END"


def hash32_sql(expr: str) -> str:
    chars = f"list_filter(string_split({expr}, ''), lambda ch: ch <> '')"
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE list_reduce([0::BIGINT] || "
            f"list_transform({chars}, lambda ch: unicode(ch)::BIGINT), "
            f"lambda h, x: (h * 131 + x) % 4294967296) END")


def _counter_sql(i: int, name: str) -> str:
    return f"CAST((user_id * {i + 3} + n) % {20 + 5 * i} AS BIGINT) AS {name}"


CTES: dict[str, tuple[list[str], str]] = {
    "raw_ratings": ([], """
        SELECT o_custkey AS user_id, l_partkey AS business_id,
               CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) AS stars,
               l_orderkey * 1000 + l_linenumber * 10 + CAST(l_quantity AS BIGINT) % 5 AS order_key,
               o_orderdate >= TIMESTAMP '2000-01-01' AS is_validation
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "ratings": (["raw_ratings"], """
        SELECT user_id, business_id, max_by(stars, order_key) AS stars
        FROM raw_ratings GROUP BY user_id, business_id"""),
    "train": (["raw_ratings"], """
        SELECT user_id, business_id, max_by(stars, order_key) AS stars
        FROM raw_ratings WHERE NOT is_validation GROUP BY user_id, business_id"""),
    "valid": (["raw_ratings"], """
        SELECT user_id, business_id, max_by(stars, order_key) AS stars
        FROM raw_ratings WHERE is_validation GROUP BY user_id, business_id"""),
    "biz": ([], f"""
        SELECT p_partkey AS business_id, p_name, p_type, p_brand, p_size,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice / 100 END AS latitude,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(-p_size AS DOUBLE) END AS longitude,
               CAST(p_size % 5 + 1 AS DOUBLE) AS stars,
               CAST(p_size AS BIGINT) AS review_count,
               CAST(p_partkey % 2 AS BIGINT) AS is_open,
               p_type AS state,
               CASE WHEN p_partkey % 13 = 0 THEN NULL
                    ELSE concat_ws(', ', p_type, p_brand, replace(p_name, ' ', ', '), concat_ws(' ', p_brand, p_size),
                                   concat_ws(' ', p_type, p_size), concat_ws(' ', p_type, p_brand)) END AS categories,
               p_partkey % 17 = 0 AS no_attributes,
               {FLAG.format(c="p_size < 10")} AS a_small,
               {FLAG.format(c="p_partkey % 3 = 0")} AS a_metal,
               'u''' || lower(p_type) || '''' AS a_kind,
               CAST(p_size % 4 + 1 AS VARCHAR) AS a_price,
               {FLAG.format(c="p_partkey % 5 = 0")} AS k_garage,
               {FLAG.format(c="p_size % 2 = 0")} AS k_lot,
               CAST(p_size % 24 AS VARCHAR) || ':0-' || CAST((p_partkey * 7) % 24 AS VARCHAR) || ':30' AS h_monday,
               CAST(p_partkey % 12 AS VARCHAR) || ':15-' || CAST(p_partkey % 12 + 8 AS VARCHAR) || ':45' AS h_friday
        FROM part"""),
    "ev": ([], """
        SELECT event_type, user_id, ts, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS business_id
        FROM events"""),
    "checkins": (["ev"], """
        SELECT business_id, CAST(count(*) AS BIGINT) AS n_checkins FROM ev
        WHERE event_type = 'signup' AND business_id IS NOT NULL GROUP BY business_id"""),
    "photos": (["ev"], """
        SELECT business_id, CAST(count(*) AS BIGINT) AS n_photos FROM ev
        WHERE event_type = 'view' AND business_id IS NOT NULL GROUP BY business_id"""),
    "btips": (["ev"], """
        SELECT business_id, CAST(count(*) AS BIGINT) AS n_tips FROM ev
        WHERE event_type = 'click' AND business_id IS NOT NULL GROUP BY business_id"""),
    "utips": (["ev"], """
        SELECT user_id, CAST(count(*) AS BIGINT) AS n_tips FROM ev
        WHERE event_type = 'click' AND business_id IS NOT NULL GROUP BY user_id"""),
    "bproj": (["biz"], """
        SELECT business_id,
               coalesce(latitude, 0.0) AS b_latitude,
               coalesce(longitude, 0.0) AS b_longitude,
               stars AS b_stars, review_count AS b_review_count, is_open AS b_is_open,
               CASE WHEN no_attributes THEN 0.0
                    ELSE ((a_small = 'True')::INT + (a_metal = 'True')::INT)::DOUBLE
                         / ((a_small IN ('True', 'False'))::INT + (a_metal IN ('True', 'False'))::INT
                            + (a_kind IN ('True', 'False'))::INT + (a_price IN ('True', 'False'))::INT)
               END AS b_true_rate,
               CAST(CASE WHEN categories IS NULL OR categories = '' THEN 0
                         ELSE len(string_split(categories, ',')) END AS BIGINT) AS b_categories
        FROM biz"""),
    "bfeat": (["bproj", "checkins", "photos", "btips"], """
        SELECT bproj.*, coalesce(n_checkins, 0) AS b_checkins, coalesce(n_photos, 0) AS b_photos,
               coalesce(n_tips, 0) AS b_tips
        FROM bproj LEFT JOIN checkins USING (business_id) LEFT JOIN photos USING (business_id)
             LEFT JOIN btips USING (business_id)"""),
    "bfeat_null": (["bproj", "checkins", "photos", "btips"], """
        SELECT bproj.*, n_checkins AS b_checkins, n_photos AS b_photos, n_tips AS b_tips
        FROM bproj LEFT JOIN checkins USING (business_id) LEFT JOIN photos USING (business_id)
             LEFT JOIN btips USING (business_id)"""),
    "usr": ([], """
        SELECT c_custkey AS user_id, c_nationkey, c_acctbal, CAST(coalesce(n_orders, 0) AS BIGINT) AS n,
               coalesce(strftime(first_order, '%Y-%m-%d'), '2000-01-01') AS yelping_since,
               CASE WHEN c_custkey % 5 = 0 THEN 'None' WHEN c_custkey % 5 = 1 THEN 'a'
                    ELSE 'a,b,' || CAST(c_nationkey AS VARCHAR) END AS friends,
               CASE WHEN c_custkey % 3 = 0 THEN 'None' ELSE '2015,2016' END AS elite
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, min(o_orderdate) AS first_order
                                 FROM orders GROUP BY o_custkey) s ON o_custkey = c_custkey"""),
    "uproj": (["usr"], f"""
        SELECT user_id, n AS u_review_count,
               CAST(date_diff('day', DATE '1970-01-01', CAST(yelping_since AS DATE)) AS BIGINT) * 86400 AS u_since,
               CAST(CASE WHEN friends = 'None' THEN 0 ELSE len(string_split(friends, ',')) END AS BIGINT) AS u_friends,
               {", ".join(_counter_sql(i, "u_" + c) for i, c in enumerate(USER_COUNTERS) if i < 4)},
               CAST(CASE WHEN elite = 'None' THEN 0 ELSE len(string_split(elite, ',')) END AS BIGINT) AS u_elite,
               c_acctbal / 1000 AS u_average_stars,
               {", ".join(_counter_sql(i, "u_" + c) for i, c in enumerate(USER_COUNTERS) if i >= 4)}
        FROM usr"""),
    "ufeat": (["uproj", "utips"], """
        SELECT uproj.*, coalesce(n_tips, 0) AS u_tips FROM uproj LEFT JOIN utips USING (user_id)"""),
    "ufeat_null": (["uproj", "utips"], """
        SELECT uproj.*, n_tips AS u_tips FROM uproj LEFT JOIN utips USING (user_id)"""),
    "train_matrix": (["train", "bfeat", "ufeat"], f"""
        SELECT t.user_id, t.business_id, t.stars,
               {", ".join(f"coalesce({c}, 0) AS {c}" for c in FEW_FEATURES)}
        FROM train t LEFT JOIN bfeat b ON t.business_id = b.business_id
             LEFT JOIN ufeat u ON t.user_id = u.user_id"""),
    "valid_matrix": (["valid", "bfeat", "ufeat"], f"""
        SELECT t.user_id, t.business_id, t.stars,
               {", ".join(f"coalesce({c}, 0) AS {c}" for c in FEW_FEATURES)}
        FROM valid t LEFT JOIN bfeat b ON t.business_id = b.business_id
             LEFT JOIN ufeat u ON t.user_id = u.user_id"""),
    "item_mean": (["train"], "SELECT business_id, avg(stars) AS im FROM train GROUP BY business_id"),
    "user_mean": (["train"], "SELECT user_id, avg(stars) AS um FROM train GROUP BY user_id"),
    "baseline": (["valid", "item_mean", "user_mean"], """
        SELECT v.user_id, v.business_id, least(greatest(im + um - 3.0, 1.0), 5.0) AS prediction
        FROM valid v JOIN item_mean i ON v.business_id = i.business_id
             JOIN user_mean u ON v.user_id = u.user_id"""),
    "scored": (["valid", "baseline"], """
        SELECT v.user_id, v.business_id, v.stars AS y, b.prediction AS p
        FROM valid v LEFT JOIN baseline b ON v.user_id = b.user_id AND v.business_id = b.business_id"""),
}

assert len(FEW_FEATURES) == len(BUSINESS_FEATURES) + len(USER_FEATURES) == 31


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {parts}\n{body}"


def _encode_text_sql(expr: str) -> str:
    return (f"CASE WHEN {expr} = 'True' THEN 1.0::DOUBLE WHEN {expr} = 'False' THEN 0.0::DOUBLE "
            f"ELSE CAST({hash32_sql(expr)} AS DOUBLE) END")


CTES.update({
    "attrs_flat": (["biz"], """
        SELECT business_id, 'small' AS attribute, a_small AS raw FROM biz WHERE NOT no_attributes
        UNION ALL SELECT business_id, 'metal', a_metal FROM biz WHERE NOT no_attributes
        UNION ALL SELECT business_id, 'kind', a_kind FROM biz WHERE NOT no_attributes
        UNION ALL SELECT business_id, 'price', a_price FROM biz WHERE NOT no_attributes"""),
    "attrs_nested": (["biz"], """
        SELECT business_id, 'garage' AS key, k_garage AS raw FROM biz WHERE NOT no_attributes
        UNION ALL SELECT business_id, 'lot', k_lot FROM biz WHERE NOT no_attributes
        UNION ALL SELECT business_id, 'valet', 'None' FROM biz WHERE NOT no_attributes"""),
    "hours_long": (["biz"], """
        SELECT business_id, day, hours_text, CASE WHEN m < 0 THEN m + 24.0 ELSE m END AS hours
        FROM (SELECT business_id, day, hours_text,
                     ((CAST(split_part(split_part(hours_text, '-', 2), ':', 1) AS INT) * 60
                       + CAST(split_part(split_part(hours_text, '-', 2), ':', 2) AS INT))
                      - (CAST(split_part(split_part(hours_text, '-', 1), ':', 1) AS INT) * 60
                         + CAST(split_part(split_part(hours_text, '-', 1), ':', 2) AS INT))) / 60.0::DOUBLE AS m
              FROM (SELECT business_id, 'Monday' AS day, h_monday AS hours_text FROM biz
                    UNION ALL SELECT business_id, 'Friday', h_friday FROM biz))"""),
    "wide_long": (["biz", "attrs_flat", "attrs_nested", "hours_long"], f"""
        SELECT business_id, trim(token) AS feature, 'category' AS kind, CAST(NULL AS VARCHAR) AS raw,
               1.0::DOUBLE AS value
        FROM (SELECT business_id, unnest(string_split(categories, ',')) AS token FROM biz
              WHERE categories IS NOT NULL)
        UNION ALL
        SELECT business_id, 'attributes$' || attribute, 'attribute', raw, {_encode_text_sql('raw')}
        FROM attrs_flat
        UNION ALL
        SELECT business_id, 'attributes$parking$' || key, 'attribute', raw,
               CASE raw WHEN 'True' THEN 1.0::DOUBLE WHEN 'False' THEN 0.0::DOUBLE ELSE NULL END
        FROM attrs_nested
        UNION ALL
        SELECT business_id, 'hours$' || day, 'hours', hours_text, hours FROM hours_long
        UNION ALL SELECT business_id, 'is_open', 'scalar', NULL, CAST(is_open AS DOUBLE) FROM biz
        UNION ALL SELECT business_id, 'latitude', 'scalar', NULL, latitude FROM biz
        UNION ALL SELECT business_id, 'longitude', 'scalar', NULL, longitude FROM biz
        UNION ALL SELECT business_id, 'review_count', 'scalar', NULL, CAST(review_count AS DOUBLE) FROM biz
        UNION ALL SELECT business_id, 'stars', 'scalar', NULL, stars FROM biz
        UNION ALL SELECT business_id, 'state', 'scalar', state, {_encode_text_sql('state')} FROM biz"""),
    "vocab": (["wide_long"], """
        SELECT feature, CASE min(CASE kind WHEN 'category' THEN 0 WHEN 'attribute' THEN 1
                                           WHEN 'hours' THEN 2 ELSE 3 END)
                        WHEN 0 THEN 'category' WHEN 1 THEN 'attribute' WHEN 2 THEN 'hours'
                        ELSE 'scalar' END AS kind
        FROM wide_long GROUP BY feature"""),
})
