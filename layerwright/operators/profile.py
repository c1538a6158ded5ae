"""Table profiles: what is in each column, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def column_profile(df: DataFrame) -> DataFrame:
    """Rows, NULLs, lowest and highest value of every column, values as text."""
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(df.columns):
        column = F.col(f"`{name}`")
        measures += [
            F.count(column).alias(f"valued{i}"),
            F.min(column).cast("string").alias(f"low{i}"),
            F.max(column).cast("string").alias(f"high{i}"),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(dtype).alias("type"),
            F.col("n_rows"),
            (F.col("n_rows") - F.col(f"valued{i}")).alias("n_nulls"),
            F.col(f"low{i}").alias("low"),
            F.col(f"high{i}").alias("high"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return df.agg(*measures).select(F.inline(F.array(*lines)))


def table_columns(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its columns as a list of (column, type) records.

    The list is as long as the table is wide; it is built from the schemas, not from the rows.
    """
    rows = [
        (table, position, name, dtype)
        for table, df in frames.items()
        for position, (name, dtype) in enumerate(df.dtypes)
    ]
    listed = spark.createDataFrame(rows, "table string, position int, column string, type string")
    record = F.struct("position", "column", "type")
    return (
        listed.groupBy("table")
        .agg(F.sort_array(F.collect_list(record)).alias("records"))
        .select(
            "table",
            F.transform(
                "records", lambda r: F.struct(r["column"].alias("column"), r["type"].alias("type"))
            ).alias("columns"),
        )
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at."""
    return df.limit(n)
