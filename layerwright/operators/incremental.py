"""Incremental loads: high-water mark, keyed replace, guarded append."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def high_water_mark(df: DataFrame, column: str) -> Any:
    """The newest value of a column, None for an empty table."""
    return df.agg(F.max(column)).first()[0]


def since(df: DataFrame, column: str, mark: Any) -> DataFrame:
    """Rows at or after the mark, as a literal comparison that reaches the Parquet scan."""
    if mark is None:
        return df
    literal = F.lit(mark)
    if df.schema[column].dataType == T.TimestampNTZType():
        literal = F.lit(mark.isoformat()).cast("timestamp_ntz")
    return df.where(F.col(column) >= literal)


def keyed_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the whole batch. Keys need not be unique.

    The batch keys are made distinct before the shuffle, so a key repeated often in the batch is
    sent once per map task.
    """
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def append_unseen(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch rows whose key the target does not hold yet; rows with a NULL key are left out.

    This is the guarded insert written as an anti join: unlike NOT IN it still works when the
    target holds a NULL key.
    """
    valued = batch
    for key in keys:
        valued = valued.where(F.col(key).isNotNull())
    return valued.join(target.select(*keys).distinct(), list(keys), "left_anti").select(
        *batch.columns
    )


def replace_batch(target: DataFrame, batch: DataFrame, batch_column: str = "batch_id") -> DataFrame:
    """Rows of an earlier attempt of the same batches dropped, the new attempt added."""
    return keyed_replace(target, batch, [batch_column])
