"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key, ``newest_first`` giving the order (names sort descending).

    The filter on the row number lets Spark keep one row per key in every map task before the
    shuffle (WindowGroupLimit), so a key with very many rows costs no more than one with few.
    """
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in newest_first]
    numbered = df.withColumn(
        "__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return numbered.filter(F.col("__n") == 1).drop("__n")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of one column, sorted, NULL left out."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
