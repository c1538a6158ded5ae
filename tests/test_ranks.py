"""Stored ranks against ranks over the whole table, after loads that touch a part of it."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from layerwright.operators.ordered import rank_table
from layerwright.sources import ranks, tables
from layerwright.sources.ranks import Ranking

RANKING = Ranking("v", ("k",), (("half", "CASE WHEN pct_rank >= 0.5D THEN 'upper' ELSE 'lower' END"),))
SCHEMA = "k int, v double, name string"


@pytest.fixture
def table(spark):
    database = f"ranks_{uuid.uuid4().hex[:8]}"
    tables.create_database(spark, database)
    yield f"{database}.ranked"
    spark.sql(f"DROP DATABASE {database} CASCADE")


def shown(df):
    return {r.k: (r["rank"], r.pct_rank) for r in df.collect()}


def folders(spark, table):
    return tables._held(tables.properties_of(spark, table))


DRAWS = {
    "spread": lambda r: r.random(),
    "hot": lambda r: r.choice([5.0] * 5 + [r.random() * 10 for _ in range(5)] + [None]),
    "equal": lambda r: 7.0,
    "null": lambda r: None,
    "nan": lambda r: r.choice([float("nan"), float("-inf"), 0.0, -0.0, 1.0, None]),
}


@pytest.mark.parametrize("draw", DRAWS.values(), ids=DRAWS)
def test_loads_give_the_ranks_of_the_whole_table(spark, table, draw):
    rng = random.Random(5)
    held = {k: (k, draw(rng), f"n{k}") for k in range(400)}
    ranks.load_all(spark.createDataFrame(list(held.values()), SCHEMA), table, RANKING, "a")
    for step in range(2):
        changed = rng.sample(range(450), 12)
        for k in changed:
            held.pop(k, None)
            if rng.random() < 0.8:
                held[k] = (k, draw(rng), f"m{step}")
        now = [held[k] for k in changed if k in held]
        keys = spark.createDataFrame([(k,) for k in changed], "k int")
        ranks.load_changes(keys, spark.createDataFrame(now, SCHEMA), table, RANKING, f"s{step}")
        whole = spark.createDataFrame(list(held.values()), SCHEMA)
        assert shown(spark.table(table)) == shown(rank_table(whole, "v", ["k"]))
        assert spark.table(table).columns == ["k", "v", "name", "rank", "pct_rank", "half"]
    assert tables.properties_of(spark, table)["made_from"] == "s1"


def test_a_load_touches_the_changed_ranges_only(spark, table):
    rows = spark.range(2000).selectExpr("CAST(id AS INT) AS k", "CAST(id AS DOUBLE) AS v", "'x' AS name")
    ranks.load_all(rows, table, RANKING)
    first = folders(spark, table)
    one = spark.createDataFrame([(1, 1999.5, "up")], SCHEMA)
    touched = ranks.load_changes(one.select("k"), one, table, RANKING)
    second = folders(spark, table)
    assert len(first) > 8 and len(touched) == 2
    assert {at for at in first if first[at] != second[at]} == set(touched)
    found = {r.k: r["rank"] for r in spark.table(table).where("k IN (0, 1, 2, 1999)").collect()}
    assert found == {1: 1, 1999: 2, 2: 1999, 0: 2000}
    assert tables.vacuum(spark, table) and spark.table(table).count() == 2000


def test_readers_neither_sort_nor_shuffle(spark, table):
    ranks.load_all(spark.range(500).selectExpr("CAST(id AS INT) AS k", "rand(1) AS v", "'x' AS name"), table, RANKING)
    plan = spark.table(table).where(F.col("k") == 3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan
    assert "hashpartitioning" not in plan and "Window" not in plan and "SortMergeJoin" not in plan


def test_ranges_that_empty_and_tables_that_empty(spark, table):
    rows = spark.createDataFrame([(k, float(k), "x") for k in range(60)], SCHEMA)
    ranks.load_all(rows, table, RANKING)
    gone = rows.where("k >= 20").select("k")
    ranks.load_changes(gone, rows.limit(0), table, RANKING)
    assert shown(spark.table(table)) == shown(rank_table(rows.where("k < 20"), "v", ["k"]))
    ranks.load_changes(rows.select("k"), rows.limit(0), table, RANKING)
    assert spark.table(table).collect() == []
    ranks.load_changes(rows.select("k"), rows, table, RANKING)
    assert shown(spark.table(table)) == shown(rank_table(rows, "v", ["k"]))
    assert ranks.load_changes(rows.limit(0).select("k"), rows.limit(0), table, RANKING, "none") == []
    assert tables.properties_of(spark, table)["made_from"] == "none"


def test_empty_at_first(spark, table):
    rows = spark.createDataFrame([(1, 2.0, "a"), (2, 3.0, "b")], SCHEMA)
    ranks.load_all(rows.limit(0), table, RANKING)
    assert spark.table(table).collect() == []
    ranks.load_changes(rows.select("k"), rows, table, RANKING)
    assert shown(spark.table(table)) == {2: (1, 0.5 * 2), 1: (2, 0.0)}


def test_when_changes_fit(spark, table):
    rows = spark.createDataFrame([(k, float(k), "x") for k in range(600)], SCHEMA)
    assert not ranks.fits(spark, table, "a", rows.columns)
    ranks.load_all(rows, table, RANKING, "a")
    assert ranks.fits(spark, table, "a", rows.columns)
    assert not ranks.fits(spark, table, "b", rows.columns)
    assert not ranks.fits(spark, table, "a", ["k", "v"])
    # all new rows at one end: the last range outgrows the others, and the next load cuts them anew
    many = spark.range(600, 9000).selectExpr("CAST(id AS INT) AS k", "CAST(id AS DOUBLE) AS v", "'x' AS name")
    ranks.load_changes(many.select("k"), many, table, RANKING, "a")
    assert not ranks.fits(spark, table, "a", rows.columns)
