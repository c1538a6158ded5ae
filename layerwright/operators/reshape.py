"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_fixed(
    df: DataFrame, keys: Sequence[str], name: str, value: str, columns: dict[str, str]
) -> DataFrame:
    """One column per listed name; ``columns`` maps the name in the data to the output column.

    A conditional max per name is a plain aggregate: it is combined before the shuffle and needs no
    job to find the names. With one value per cell, as expected, max is that value.
    """
    cells = [
        F.max(F.when(F.col(name) == raw, F.col(value))).alias(out) for raw, out in columns.items()
    ]
    return df.groupBy(*keys).agg(*cells)


def unpivot(
    df: DataFrame, keys: Sequence[str], columns: dict[str, str], name: str, value: str
) -> DataFrame:
    """The reverse of ``pivot_fixed``; empty cells give no row."""
    wide = df.select(*keys, *[F.col(out).alias(raw) for raw, out in columns.items()])
    long = wide.unpivot(list(keys), list(columns), name, value)
    return long.where(F.col(value).isNotNull())
