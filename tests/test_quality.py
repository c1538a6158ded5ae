"""Every check on a passing and on a failing frame."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerwright.operators import quality as q


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 5), (2, "b", 300), (2, "c", -1), (None, None, None), (None, "a", 0)],
        "k int, t string, v int",
    )


@pytest.fixture()
def clean(spark):
    return spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k int, t string, v int")


def checks(spark):
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    return [
        q.not_null("k"),
        q.accepted_values("t", ["a", "b"]),
        q.accepted_range("v", 0, 255),
        q.min_value("v", 0),
        q.row_rule("rule", ["k", "v"], F.col("k") > F.col("v")),
        q.unique("k"),
        q.unique_combination("k", "t"),
        q.relationships("k", parent, "id"),
    ]


def test_failing(spark, df):
    found = {r["check"]: r.failures for r in q.run_checks(df, checks(spark)).collect()}
    assert found == {
        "not_null": 2,
        "accepted_values": 1,
        "accepted_range": 2,
        "min_value": 1,
        "rule": 1,
        "unique": 1,
        "unique_combination": 0,
        "relationships": 2,
    }
    for check in checks(spark):
        assert q.failing_rows(df, check).count() == found[check.name]


def test_passing(spark, clean):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    passing = [c for c in checks(spark) if c.name != "relationships"]
    passing.append(q.relationships("k", parent, "id"))
    assert {r.failures for r in q.run_checks(clean, passing).collect()} == {0}


def test_unique_combination_counts_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert q.failing_rows(df, q.unique_combination("a", "b")).count() == 1
    assert q.failing_rows(df, q.unique("a")).count() == 0


def test_row_checks_share_one_pass(spark, df):
    only_rows = [c for c in checks(spark) if c.bad is not None]
    plan = q.run_checks(df, only_rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_row_checks_ride_on_the_first_uniqueness_check(spark, df):
    together = [c for c in checks(spark) if c.bad is not None or c.name == "unique"]
    plan = q.run_checks(df, together)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    assert {r.failures for r in q.run_checks(df.limit(0), together).collect()} == {0}


def test_group_without_and_rank_gaps(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "k int, slot int")
    assert [r.k for r in q.group_without(df, "k", F.col("slot") == 1).collect()] == [2]
    ranks = spark.createDataFrame([(1,), (2,), (4,)], "rank int")
    assert tuple(q.rank_gaps(ranks).first()) == (4, 3)
    assert q.rank_gaps(ranks.where("rank < 4")).count() == 0


@pytest.mark.parametrize(
    "age, status",
    [
        (timedelta(days=14), "pass"),
        (timedelta(days=15), "pass"),
        (timedelta(days=15, seconds=1), "warn"),
        (timedelta(days=30), "warn"),
        (timedelta(days=30, microseconds=1), "error"),
    ],
)
def test_freshness(spark, age, status):
    as_of = datetime(2024, 6, 1)
    df = spark.createDataFrame([(as_of - age,), (datetime(2020, 1, 1),)], "at timestamp_ntz")
    row = q.freshness(df, "at", as_of, timedelta(days=15), timedelta(days=30)).first()
    assert row.status == status
    assert row.age_seconds == age.total_seconds()


def test_freshness_of_nothing(spark):
    df = spark.createDataFrame([], "at timestamp_ntz")
    row = q.freshness(df, "at", datetime(2024, 6, 1), timedelta(1), timedelta(2)).first()
    assert row.status == "error"
