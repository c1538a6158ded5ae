"""Landings built from source tables: no task gets more rows than it can hold as payloads."""

import pytest
from pyspark.sql import functions as F

from workloads import landing
from workloads.registry import table

LEAST = 32


@pytest.mark.parametrize(
    "name, source, key", [("pokemons", "part", "p_partkey"), ("pokemon_species", "part", "p_partkey"),
                          ("pokemon_catalogue", "part", "p_partkey"), ("moves", "supplier", "s_suppkey")]
)
def test_payloads_are_dealt_by_rows(spark, folder, tmp_path, monkeypatch, name, source, key):
    monkeypatch.setattr(landing, "ROWS_OF_A_TASK", LEAST, raising=False)
    # one file, as a small table often is, which would be one task whatever its payloads need
    path = str(tmp_path)
    for needed in {source, "supplier"}:
        table(spark, folder, needed).coalesce(1).write.parquet(f"{path}/{needed}.parquet")
    landed = landing.BUILDERS[name](spark, path)
    tasks = landed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert tasks <= 2 * LEAST
    rows = table(spark, path, source)
    first = landed.where(f"fetch_date = TIMESTAMP_NTZ '{landing.FIRST}'")
    assert first.count() == rows.count()
    assert "id" not in landed.columns or first.select("id").distinct().count() == rows.select(key).distinct().count()
