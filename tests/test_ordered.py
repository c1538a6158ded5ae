"""Ranks and previous rows against brute force, with hot values and groups spanning ranges."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerwright.operators.ordered import previous_in_group, rank_table

NAN = float("nan")


def brute_ranks(rows):
    valued = [v for v, _ in rows if v is not None]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0.0), r[1]))
    rank = {key: i + 1 for i, (_, key) in enumerate(order)}
    out = {}
    for value, key in rows:
        below = len(valued) if value is None else sum(v < value for v in valued)
        out[key] = (rank[key], 0.0 if len(rows) < 2 else below / (len(rows) - 1))
    return out


@pytest.mark.parametrize(
    "draw",
    [
        lambda r: r.random(),
        lambda r: r.choice([1.0, 1.0, 1.0, 2.0, 3.0, None]),
        lambda r: 7.0,
        lambda r: None,
        lambda r: r.choice([5.0] * 10 + [r.random() * 10]),
        lambda r: r.choice([0.0, -0.0, 1.0]),
    ],
    ids=["spread", "few", "equal", "null", "hot", "zeros"],
)
def test_rank_table_matches_brute_force(spark, plain_ranges, draw):
    rng = random.Random(3)
    rows = [(draw(rng), key) for key in range(600)]
    df = spark.createDataFrame(rows, "v double, k int")
    got = {r.k: (r["rank"], r.pct_rank) for r in rank_table(df, "v", ["k"]).collect()}
    assert got == brute_ranks(rows)


def test_rank_table_uses_several_ranges(spark, plain_ranges):
    df = spark.range(1000).selectExpr("1 AS v", "id")
    plan = rank_table(df, "v", ["id"])
    assert plan.select(F.max("rank")).first()[0] == 1000
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text


def test_rank_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(3.0, 1)], "v double, k int")
    assert [tuple(r) for r in rank_table(df, "v", ["k"]).collect()] == [(3.0, 1, 1, 0.0)]
    assert rank_table(df.limit(0), "v", ["k"]).collect() == []


def test_rank_with_nan(spark, plain_ranges):
    rows = [(NAN, k) for k in range(200)] + [(float(k), k) for k in range(200, 300)]
    df = spark.createDataFrame(rows, "v double, k int")
    got = {r.k: (r["rank"], r.pct_rank) for r in rank_table(df, "v", ["k"]).collect()}
    assert {got[k][1] for k in range(200)} == {100 / 299}
    assert got[299] == (201, 99 / 299)


def test_previous_in_group_matches_lag(spark, plain_ranges):
    rng = random.Random(4)
    rows = [
        (rng.choice([1, 1, 1, 1, 2, None]), rng.choice("ab"), rng.choice([None, 1, 2, 3, 40]), i)
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "e int, t string, p int, id int")
    window = Window.partitionBy("e", "t").orderBy("p", "id")
    expected = df.withColumn("prev", F.lag("p").over(window)).withColumn(
        "has", F.lag("id").over(window).isNotNull()
    )
    got = previous_in_group(df, ["e", "t"], ["p", "id"], "p", "prev", "has")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_previous_in_group_one_hot_group_is_split(spark, plain_ranges):
    df = spark.range(4000).selectExpr("1 AS e", "id AS p")
    got = previous_in_group(df, ["e"], ["p"], "p", "prev")
    assert got.where("prev IS NULL").count() == 1
    assert got.where("prev = p - 1").count() == 3999
    rows_per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert rows_per_task < 2000


def exchanges(df):
    """Shuffles in the plan of a result, and its joins."""
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning"), text.count("Join")


def test_ranks_take_one_exchange_and_no_join(spark, plain_ranges):
    """A third of the rows share one value; the rows move once, and ties are settled without a join."""
    rng = random.Random(6)
    rows = [(5.0 if key % 3 == 0 else rng.random() * 10, key) for key in range(3000)]
    df = spark.createDataFrame(rows, "v double, k int")
    found = rank_table(df, "v", ["k"])
    assert exchanges(found) == (1, 0)
    assert {r.k: (r["rank"], r.pct_rank) for r in found.collect()} == brute_ranks(rows)
    per_task = found.where("v = 5").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 600


def test_previous_row_takes_one_exchange(spark, plain_ranges):
    """A third of the rows in one group, which spans several ranges."""
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id % 101) AS e", "id AS p", "id * 2 AS w")
    found = previous_in_group(df, ["e"], ["p"], "w", "prev", "has")
    assert exchanges(found)[0] == 1
    window = Window.partitionBy("e").orderBy("p")
    lagged = F.lag("w").over(window)
    expected = df.withColumn("prev", lagged).withColumn("has", lagged.isNotNull())
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("kind", ["string", "date", "decimal(12,2)", "timestamp", "boolean"])
def test_ranks_of_other_types(spark, plain_ranges, kind):
    sql = {
        "string": "string(id % 37)",
        "date": "date_add(DATE'2020-01-01', int(id % 37))",
        "decimal(12,2)": "CAST(id % 37 AS decimal(12,2)) / 4",
        "timestamp": "timestamp_seconds(id % 37)",
        "boolean": "id % 2 = 0",
    }[kind]
    df = spark.range(700).selectExpr(f"IF(id % 11 = 0, NULL, {sql}) AS v", "id AS k")
    found = rank_table(df, "v", ["k"])
    every = Window.orderBy(F.col("v").desc_nulls_last(), "k")
    share = F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last()))
    expected = df.withColumn("rank", F.row_number().over(every)).withColumn("pct_rank", share)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
