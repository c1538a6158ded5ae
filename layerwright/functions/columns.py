"""Scalar column expressions. All of them stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound of each tier on the ascending percent rank, best first.
TIER_BOUNDS = (("S", 0.95), ("A", 0.80), ("B", 0.55), ("C", 0.30), ("D", 0.10))
LOWEST_TIER = "F"

# Fixed value: what stands for NULL inside a surrogate key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the columns as text, joined by '-', with a marker for NULL."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARKER)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def url_tail(url: Column | str) -> Column:
    """Last path segment of a URL, whether or not it ends in a slash."""
    return F.element_at(F.split(F.rtrim(_col(url), F.lit("/")), "/"), -1)


def url_segment(url: Column | str, position: int = -2) -> Column:
    """A path segment counted like SQL ``split_part``; -2 is the id of a slash-ended URL.

    A position before the start gives NULL rather than '', so that the result can be cast.
    """
    return F.nullif(F.split_part(_col(url), F.lit("/"), F.lit(position)), F.lit(""))


def clean_text(text: Column | str) -> Column:
    """Form feeds and newlines become spaces."""
    return F.translate(_col(text), "\f\n", "  ")


def total(columns: Iterable[str]) -> Column:
    """Sum of columns within a row; NULL as soon as one part is NULL."""
    return reduce(lambda left, right: left + right, [F.col(c) for c in columns])


def round_scaled(value: Column | str, places: int = 2) -> Column:
    """Round the value scaled up by ``places``, halves away from zero.

    Unlike ``round(value, places)`` this takes 2.3 / 92, stored as just under 0.025, to 0.03.
    """
    scale = F.lit(float(10**places))
    return F.round(_col(value) * scale) / scale


def tier(percent_rank: Column | str) -> Column:
    """Tier label of an ascending percent rank."""
    rank = _col(percent_rank)
    (label, bound), *rest = TIER_BOUNDS
    ladder = F.when(rank >= bound, label)
    for label, bound in rest:
        ladder = ladder.when(rank >= bound, label)
    return ladder.otherwise(LOWEST_TIER)


def tier_sql(percent_rank: str) -> str:
    """The same as SQL text, for the text of a view."""
    ladder = " ".join(f"WHEN {percent_rank} >= {bound!r}D THEN '{label}'" for label, bound in TIER_BOUNDS)
    return f"CASE {ladder} ELSE '{LOWEST_TIER}' END"


def as_utc_timestamp(text: Column | str) -> Column:
    """ISO text, with or without an offset, as the UTC wall-clock time."""
    moment = F.to_timestamp(_col(text))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))
