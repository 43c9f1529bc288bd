"""Explicit schemas of the source entities (no schema inference)."""

from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RATINGS = _struct(("user_id", S), ("business_id", S), ("stars", D))
PAIRS = _struct(("user_id", S), ("business_id", S))
PREDICTIONS = _struct(("user_id", S), ("business_id", S), ("prediction", D))

BUSINESS = _struct(
    ("business_id", S), ("name", S), ("neighborhood", S), ("address", S),
    ("city", S), ("state", S), ("postal_code", S),
    ("latitude", D), ("longitude", D), ("stars", D),
    ("review_count", L), ("is_open", L),
    ("attributes", T.MapType(S, S)), ("categories", S), ("hours", T.MapType(S, S)),
)
CHECKIN = _struct(("business_id", S), ("time", T.MapType(S, L)))
PHOTO = _struct(("business_id", S))
TIP = _struct(("business_id", S), ("user_id", S))

# The user counters in source order after review_count .. average_stars.
USER_COUNTERS = [
    "useful", "funny", "cool", "fans",
    "compliment_hot", "compliment_more", "compliment_profile", "compliment_cute",
    "compliment_list", "compliment_note", "compliment_plain", "compliment_cool",
    "compliment_funny", "compliment_writer", "compliment_photos",
]
USER = _struct(
    ("user_id", S), ("review_count", L), ("yelping_since", S), ("friends", S),
    ("elite", S), ("average_stars", D), *[(c, L) for c in USER_COUNTERS],
)

ENTITY_SCHEMAS = {
    "business": BUSINESS, "checkin": CHECKIN, "photo": PHOTO, "tip": TIP, "user": USER,
}

# Keys of a business record that never become features (fixed values).
BUSINESS_DENYLIST = ["business_id", "name", "neighborhood", "address", "city", "postal_code"]
BUSINESS_MAPS = ["attributes", "hours"]
