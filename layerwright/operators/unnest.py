"""Arrays inside payloads to rows. A parent whose array is empty or NULL gives no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _elements(df: DataFrame, array: str | Column, element: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, the position from 0 and the element, one row per array element.

    A plain explode makes Spark put a filter on the array's size below it, and with the array coming
    from ``from_json`` the payload is then parsed once more for the filter. The outer form has no
    such filter; a position is there exactly when there is an element, so the result is the same.
    """
    column = F.col(array) if isinstance(array, str) else array
    rows = df.select(*keep, F.posexplode_outer(column).alias("__at", element))
    return rows.where(F.col("__at").isNotNull())


def unnest(df: DataFrame, array: str | Column, fields: dict[str, str], *keep: str) -> DataFrame:
    """One row per array element: the ``keep`` columns plus ``fields`` as {path: output name}."""
    rows = _elements(df, array, "__element", keep)
    picked = [F.col(f"__element.{path}").alias(name) for path, name in fields.items()]
    return rows.select(*keep, *picked)


def unnest_nested(
    df: DataFrame,
    outer: str,
    inner: str,
    outer_fields: dict[str, str],
    inner_fields: dict[str, str],
    *keep: str,
) -> DataFrame:
    """Two levels: one row per element of the ``inner`` array of every ``outer`` element."""
    groups = unnest(df, outer, {**outer_fields, inner: "__inner"}, *keep)
    return unnest(groups, "__inner", inner_fields, *keep, *outer_fields.values())


def unnest_whole(df: DataFrame, array: str | Column, element: str, *keep: str) -> DataFrame:
    """One row per array element, the element kept as it is."""
    return _elements(df, array, element, keep).select(*keep, element)


def unnest_with_position(df: DataFrame, array: str, element: str, *keep: str) -> DataFrame:
    """One row per element with its position counted from 1."""
    rows = _elements(df, array, element, keep)
    return rows.select(*keep, (F.col("__at") + 1).alias("position"), element)


def with_matching(df: DataFrame, key: str, candidates: DataFrame, value: str) -> DataFrame:
    """``value`` of the candidates joined back by key; no match gives NULL, two give two rows."""
    return df.join(candidates.select(key, value), key, "left")
