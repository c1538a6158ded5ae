from layerwright.functions.columns import (
    as_utc_timestamp,
    clean_text,
    round_scaled,
    surrogate_key,
    tier,
    tier_sql,
    total,
    url_segment,
    url_tail,
)
from layerwright.functions.payload import (
    array_of,
    first_match,
    json_text,
    last_match,
    matching,
    parse,
    payload_subset,
    raw_elements,
)

__all__ = [
    "array_of",
    "as_utc_timestamp",
    "clean_text",
    "first_match",
    "json_text",
    "last_match",
    "matching",
    "parse",
    "payload_subset",
    "raw_elements",
    "round_scaled",
    "surrogate_key",
    "tier",
    "tier_sql",
    "total",
    "url_segment",
    "url_tail",
]
