"""Parquet copies of raw tables, with the row counts of both sides compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerwright.sources import tables

COUNTS = "table string, source_rows bigint, copied_rows bigint, status string"


def _verdict(name: str, source: int, copied: int) -> tuple:
    return (name, source, copied, "OK" if source == copied else "MISMATCH")


def export_archive(spark: SparkSession, frames: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write each non-empty table below ``folder`` and compare counts; empty ones are skipped.

    The rows are counted while they are written, so a table is evaluated once beyond the look for a
    first row. Earlier files of a table are replaced.
    """
    report = []
    for name, df in frames.items():
        if df.isEmpty():
            report.append((name, 0, 0, "SKIPPED"))
            continue
        path = f"{folder.rstrip('/')}/{name}.parquet"
        written = Observation()
        df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        report.append(_verdict(name, written.get["n"], spark.read.parquet(path).count()))
    return spark.createDataFrame(report, COUNTS)


def seed_from_archive(
    spark: SparkSession, database: str, files: dict[str, str]
) -> DataFrame:
    """Full replace of ``database`` tables from Parquet ``{table: path}``, counts and columns compared."""
    tables.create_database(spark, database)
    report = []
    for name, path in files.items():
        archived = spark.read.parquet(path)
        tables.replace_table(archived, f"{database}.{name}")
        seeded = spark.table(f"{database}.{name}")
        row = _verdict(name, archived.count(), seeded.count())
        if [(f.name, f.dataType) for f in seeded.schema] != [(f.name, f.dataType) for f in archived.schema]:
            row = (*row[:3], "MISMATCH")
        report.append(row)
    return spark.createDataFrame(report, COUNTS)
