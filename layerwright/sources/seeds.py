"""Small CSV dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the two seeds.
STARTERS = "generation int, poke_id bigint"
LEGENDARIES = "poke_id bigint, is_legendary boolean"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header line. A byte-order mark at its start is dropped by the reader."""
    return spark.read.csv(path, schema=schema, header=True)
