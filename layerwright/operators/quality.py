"""Data checks. A check's failures are the rows it returns; none means it passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT = "check string, columns string, failures bigint"


@dataclass(frozen=True)
class Check:
    """One check of one table. ``bad`` is set for checks that look at a row on its own."""

    name: str
    columns: tuple[str, ...]
    bad: Column | None = None
    parent: DataFrame | None = None
    parent_column: str | None = None


def not_null(column: str) -> Check:
    return Check("not_null", (column,), F.col(column).isNull())


def accepted_values(column: str, values: Sequence[Any]) -> Check:
    return Check("accepted_values", (column,), ~F.col(column).isin(list(values)))


def accepted_range(column: str, low: Any, high: Any) -> Check:
    return Check("accepted_range", (column,), (F.col(column) < low) | (F.col(column) > high))


def min_value(column: str, low: Any) -> Check:
    return Check("min_value", (column,), F.col(column) < low)


def row_rule(name: str, columns: Sequence[str], bad: Column) -> Check:
    """A hand-written rule about single rows."""
    return Check(name, tuple(columns), bad)


def unique(column: str) -> Check:
    """Failures are the repeated values, NULL left out."""
    return Check("unique", (column,))


def unique_combination(*columns: str) -> Check:
    """Failures are the repeated combinations, those with NULLs included."""
    return Check("unique_combination", tuple(columns))


def relationships(column: str, parent: DataFrame, parent_column: str) -> Check:
    """Failures are the rows whose value, if any, is not in the parent."""
    return Check("relationships", (column,), None, parent, parent_column)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows behind a failing check: table rows, or repeated keys with their count."""
    if check.bad is not None:
        return df.where(check.bad)
    if check.name == "relationships":
        parent = check.parent.select(F.col(check.parent_column).alias(check.columns[0])).distinct()
        valued = df.where(F.col(check.columns[0]).isNotNull())
        return valued.join(parent, check.columns[0], "left_anti")
    return _repeated(df, check)


def _is_repeated(check: Check) -> Column:
    """Of a key with its row count ``n``: is it a failure of the uniqueness check?"""
    again = F.col("n") > 1
    return again & F.col(check.columns[0]).isNotNull() if check.name == "unique" else again


def _repeated(df: DataFrame, check: Check) -> DataFrame:
    counted = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(_is_repeated(check))


def _orphans(df: DataFrame, check: Check) -> DataFrame:
    # counted per value before the join, so a frequent value is one row in the shuffle
    column = check.columns[0]
    values = df.where(F.col(column).isNotNull()).groupBy(column)
    per_value = values.agg(F.count(F.lit(1)).alias("n"))
    parent = check.parent.select(F.col(check.parent_column).alias(column)).distinct()
    orphans = per_value.join(parent, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("f0"))


def _lines(counted: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """A one-row frame of failure counts f0, f1, ... as one line per check."""
    lines = [
        F.struct(
            F.lit(check.name).alias("check"),
            F.lit(",".join(check.columns)).alias("columns"),
            F.col(f"f{i}").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*lines)))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: its name, its columns and the number of failures.

    All row checks share one aggregate pass. If the table has a uniqueness check, they are counted
    in the same pass, per key and before the shuffle; so a table with one of each is read once.
    Every further uniqueness or foreign-key check takes one shuffle of its pre-aggregated key.
    """
    per_row = [c for c in checks if c.bad is not None]
    keyed = [c for c in checks if c.name.startswith("unique")]
    parts: list[DataFrame] = []
    bad = [F.count_if(c.bad) for c in per_row]
    if keyed:
        first, *keyed = keyed
        named = [column.alias(f"b{i}") for i, column in enumerate(bad)]
        per_key = df.groupBy(*first.columns).agg(F.count(F.lit(1)).alias("n"), *named)
        counted = per_key.agg(
            F.count_if(_is_repeated(first)).alias("f0"),
            *[F.coalesce(F.sum(f"b{i}"), F.lit(0)).alias(f"f{i + 1}") for i in range(len(bad))],
        )
        parts.append(_lines(counted, [first, *per_row]))
    elif per_row:
        counted = df.agg(*[column.alias(f"f{i}") for i, column in enumerate(bad)])
        parts.append(_lines(counted, per_row))
    for check in keyed:
        counted = _repeated(df, check).agg(F.count(F.lit(1)).alias("f0"))
        parts.append(_lines(counted, [check]))
    for check in checks:
        if check.name == "relationships":
            parts.append(_lines(_orphans(df, check), [check]))
    return reduce(DataFrame.unionByName, parts)


def group_without(df: DataFrame, key: str, wanted: Column) -> DataFrame:
    """Keys none of whose rows satisfy ``wanted``."""
    return (
        df.groupBy(key)
        .agg(F.sum(F.when(wanted, 1).otherwise(0)).alias("hits"))
        .where("hits = 0")
        .select(key)
    )


def rank_gaps(df: DataFrame, rank: str = "rank") -> DataFrame:
    """One row when the highest rank is not the row count."""
    return df.agg(F.max(rank).alias("max_rank"), F.count(F.lit(1)).alias("row_count")).where(
        "max_rank != row_count"
    )


def freshness(
    df: DataFrame, column: str, as_of: datetime, warn_after: timedelta, error_after: timedelta
) -> DataFrame:
    """Age of the newest row at ``as_of`` against two limits: pass, warn or error.

    An age equal to a limit has not passed it. A table without rows is an error.
    """
    age = F.lit(as_of.isoformat()).cast("timestamp_ntz") - F.col("newest")
    seconds = age.cast("interval second").cast("decimal(18,6)")
    return (
        df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("newest"))
        .withColumn("age_seconds", seconds.cast("double"))
        .withColumn(
            "status",
            F.when(F.col("newest").isNull(), "error")
            .when(seconds > error_after.total_seconds(), "error")
            .when(seconds > warn_after.total_seconds(), "warn")
            .otherwise("pass"),
        )
    )
