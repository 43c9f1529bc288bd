from starcast.functions.scalars import (  # noqa: F401
    attribute_count, category_count, checkin_total, clip_rating, elite_count,
    encode_literal, encode_text, friend_count, geo_default, hash32,
    is_dict_literal, list_count, opening_hours, parse_dict_literal,
    since_epoch, strip, true_attribute_rate,
)
