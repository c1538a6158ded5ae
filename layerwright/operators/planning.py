"""Which rows are still to be loaded, and which landed rows cannot be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_ids(
    wanted: DataFrame, loaded: DataFrame, column: str, loaded_column: str | None = None
) -> DataFrame:
    """Distinct ids of ``wanted`` that ``loaded`` does not hold; gaps are allowed, NULLs ignored."""
    have = loaded.select(F.col(loaded_column or column).alias(column)).distinct()
    want = wanted.select(column).where(F.col(column).isNotNull()).distinct()
    return want.join(have, column, "left_anti")


def missing_from_range(
    loaded: DataFrame, column: str, first: int, last: int, into: str = "id"
) -> DataFrame:
    """Ids of ``first``..``last`` not loaded. The range is generated in parallel by Spark."""
    wanted = loaded.sparkSession.range(first, last + 1).toDF(into)
    return missing_ids(wanted, loaded, into, column)


def next_batch(missing: DataFrame, column: str, size: int) -> DataFrame:
    """The first ``size`` ids to load next."""
    return missing.orderBy(column).limit(size)


def anything_to_do(missing: DataFrame) -> bool:
    return not missing.isEmpty()


def split_malformed(df: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(rows whose payload is JSON, rows for quarantine). A NULL payload counts as bad."""
    readable = F.try_parse_json(payload).isNotNull()
    return df.where(readable), df.where(~readable)
