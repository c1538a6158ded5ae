"""Filters, flags and top-k over finished tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.session import cut_lineage


def with_flag(df: DataFrame, members: DataFrame, key: str, flag: str, member_key: str | None = None) -> DataFrame:
    """A boolean column: is the row's key among the members? No row is added or lost."""
    ids = members.select(F.col(member_key or key).alias(key)).distinct()
    ids = ids.withColumn("__found", F.lit(True))
    joined = df.join(ids, key, "left").withColumn(flag, F.col("__found").isNotNull())
    return joined.select(*df.columns, flag)


def having_any(
    df: DataFrame, members: DataFrame, key: str, column: str, values: Sequence[Any]
) -> DataFrame:
    """Rows whose key occurs in ``members`` with one of ``values``; no values means no filter."""
    if not values:
        return df
    chosen = members.where(F.col(column).isin(list(values))).select(key).distinct()
    return df.join(chosen, key, "left_semi").select(*df.columns)


def top_k(df: DataFrame, k: int, measure: str, *tie_break: str | Column) -> DataFrame:
    """Highest ``measure`` first, NULLs last, ties by ``tie_break``. Each task keeps only k rows."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *tie_break).limit(k)


#: Slices of candidates, each so many times as large as the one before, ahead of a join of the rest.
SLICES = 3
GROWTH = 8


def top_k_joined(
    df: DataFrame, k: int, measure: str, key: str, join: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``top_k`` of ``join(df)`` where the measure and the unique ``key`` are columns of ``df``.

    ``join`` may drop rows of ``df`` or repeat them, row by row. Only the best candidates are joined: first
    a few times ``k``, then the next ones below them, until ``k`` rows have come through; whatever lies
    below the last candidate then cannot be among them. Where few candidates find a partner, the rest is
    joined as a whole after ``SLICES`` slices.
    """
    rest, size, found = df, 4 * k, []
    n = 0
    for _ in range(SLICES):
        candidates = cut_lineage(top_k(rest, size, measure, key))
        joined = cut_lineage(join(candidates))
        found.append(joined)
        n += joined.count()
        last = candidates.orderBy(F.col(measure).asc_nulls_first(), F.col(key).desc()).select(measure, key).first()
        if n >= k or candidates.count() < size:
            break
        rest = df.where(_below(measure, key, *last))
        size *= GROWTH
    else:
        found.append(join(rest))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return top_k(every, k, measure, key)


def _below(measure: str, key: str, value: Any, last: Any) -> Column:
    """Does a row come after the one with this measure and key, from the highest measure down?"""
    if value is None:
        return F.col(measure).isNull() & (F.col(key) > last)
    tied = (F.col(measure) == value) & (F.col(key) > last)
    return tied | (F.col(measure) < value) | F.col(measure).isNull()


def value_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def count_per_group(df: DataFrame, *keys: str, into: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(into))
