"""Operators on small frames with answers worked out by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from layerwright import functions as fn
from layerwright.operators import incremental as inc
from layerwright.operators import planning as plan
from layerwright.operators import serving
from layerwright.operators.history import validity_windows
from layerwright.operators.latest import distinct_values, latest_per_key
from layerwright.operators.profile import column_profile, sample_rows, table_columns
from layerwright.operators.reshape import pivot_fixed, unpivot
from layerwright.operators.unnest import (
    unnest,
    unnest_nested,
    unnest_whole,
    unnest_with_position,
    with_matching,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


# ---- functions -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "url, tail, segment",
    [
        ("https://x/v2/move/13/", "13", "13"),
        ("https://x/v2/move/13", "13", "move"),
        ("13", "13", None),
        (None, None, None),
    ],
)
def test_url_ids(spark, url, tail, segment):
    text = F.lit(url).cast("string")
    assert one(spark, fn.url_tail(text)) == tail
    assert one(spark, fn.url_segment(text)) == segment


def test_clean_text(spark):
    assert one(spark, fn.clean_text(F.lit("a\fb\nc"))) == "a b c"


def test_surrogate_key_marks_null(spark):
    import hashlib

    key = one(spark, fn.surrogate_key(F.lit(1), F.lit(None).cast("int"), F.lit("x")))
    text = "1-_dbt_utils_surrogate_key_null_-x"
    assert key == hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "share, label",
    [(1.0, "S"), (0.95, "S"), (0.949, "A"), (0.8, "A"), (0.55, "B"), (0.3, "C"), (0.1, "D"), (0.0, "F")],
)
def test_tier_bounds(spark, share, label):
    assert one(spark, fn.tier(F.lit(share))) == label


def test_total_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(fn.total(["a", "b"])).collect()] == [3, None]


def test_round_scaled(spark):
    assert one(spark, fn.round_scaled(F.lit(2.3) / F.lit(92.0))) == 0.03


@pytest.mark.parametrize(
    "text", ["2024-05-01T10:00:00+02:00", "2024-05-01T08:00:00Z", "2024-05-01T08:00:00"]
)
def test_iso_text_to_utc(spark, text):
    assert one(spark, fn.as_utc_timestamp(F.lit(text))) == datetime(2024, 5, 1, 8)


def test_payload_fields(spark):
    payload = F.lit('{"a": null, "b": {"c": 7}, "x": [1, {"y": 2}], "z": 1}')
    assert one(spark, fn.json_text(payload, "$.a")) is None
    assert one(spark, fn.parse(payload, "b struct<c:string>")["b"]["c"]) == "7"
    assert one(spark, fn.payload_subset(payload, "z int")) == '{"z":1}'
    assert one(spark, fn.raw_elements(fn.json_text(payload, "$.x"))) == ["1", '{"y":2}']


@pytest.mark.parametrize(
    "langs, last, first",
    [(["en", "fr", "en", "fr"], 2, 0), (["fr"], None, None), ([], None, None), (None, None, None)],
)
def test_first_and_last_match(spark, langs, last, first):
    entries = None if langs is None else [(i, (lang,)) for i, lang in enumerate(langs)]
    df = spark.createDataFrame([(entries,)], "e array<struct<at:int, language:struct<name:string>>>")
    got = df.select(
        fn.last_match("e", "language.name", "en")["at"],
        fn.first_match("e", "language.name", "en")["at"],
    ).first()
    assert tuple(got) == (last, first)


# ---- unnest --------------------------------------------------------------------------------------


def test_unnest_drops_parents_without_elements(spark):
    df = spark.createDataFrame(
        [(1, [("x",), (None,)]), (2, []), (3, None)], "id int, a array<struct<n:string>>"
    )
    assert rows(unnest(df, "a", {"n": "name"}, "id")) == [(1, "x"), (1, None)]
    assert len(rows(unnest_whole(df, "a", "e", "id"))) == 2
    positions = unnest_with_position(df, "a", "e", "id").select("id", "position")
    assert rows(positions) == [(1, 1), (1, 2)]


def test_unnest_keeps_null_elements(spark):
    df = spark.createDataFrame([(1, ["x", None])], "id int, a array<string>")
    assert rows(unnest_whole(df, "a", "e", "id")) == [(1, "x"), (1, None)]


def test_unnest_nested(spark):
    df = spark.createDataFrame(
        [(1, [("g1", [(1, "a"), (2, "b")]), ("g2", [])]), (2, None)],
        "id int, o array<struct<u:string, i:array<struct<s:int, t:string>>>>",
    )
    got = unnest_nested(df, "o", "i", {"u": "u"}, {"s": "s", "t": "t"}, "id")
    assert rows(got) == [(1, "g1", 1, "a"), (1, "g1", 2, "b")]


def test_with_matching_keeps_multiplicity(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    found = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert rows(with_matching(df, "k", found, "v")) == [(1, "a"), (1, "b"), (2, None)]


# ---- latest, pivot -------------------------------------------------------------------------------


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "old"), (1, "2024-02-01", "b"), (1, "2024-02-01", "a"), (2, None, "x")],
        "k int, d string, v string",
    )
    assert rows(latest_per_key(df, ["k"], ["d", "v"])) == [(1, "2024-02-01", "b"), (2, None, "x")]
    assert rows(latest_per_key(df, ["k"], ["d", F.col("v").asc()]))[0][2] == "a"


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS d")
    plan_text = latest_per_key(df, ["k"], ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan_text and "WindowGroupLimit" in plan_text


def test_pivot_and_back(spark):
    df = spark.createDataFrame(
        [(1, "a-x", 5), (1, "b", 6), (2, "b", 7), (2, "other", 9)], "k int, n string, v int"
    )
    columns = {"a-x": "a_x", "b": "b"}
    wide = pivot_fixed(df, ["k"], "n", "v", columns)
    assert rows(wide) == [(1, 5, 6), (2, None, 7)]
    assert rows(unpivot(wide, ["k"], columns, "n", "v")) == [(1, "a-x", 5), (1, "b", 6), (2, "b", 7)]


def test_distinct_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert [r.v for r in distinct_values(df, "v").collect()] == ["a", "b"]


# ---- history -------------------------------------------------------------------------------------


@pytest.fixture()
def log(spark):
    past = spark.createDataFrame(
        [(1, 1, "a", 3), (1, 1, "b", 5), (2, 1, "n", 5), (4, 2, "gone", 2)],
        "e int, slot int, t string, period int",
    )
    current = spark.createDataFrame(
        [(1, 1, "c"), (2, 1, "f"), (3, 1, "z"), (4, 1, "y"), (9, 1, "w")], "e int, slot int, t string"
    )
    introduced = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 1)], "e int, intro int")
    return past, current, introduced


def windows(log, rule):
    found = validity_windows(*log, "e", "slot", "t", rule=rule)
    return {(r.e, r.slot, r.t): (r.valid_from, r.valid_to) for r in found.collect()}


def test_documented_windows(log):
    assert windows(log, "documented") == {
        (1, 1, "a"): (1, 3),
        (1, 1, "b"): (4, 5),
        (1, 1, "c"): (6, None),
        (2, 1, "n"): (1, 5),
        (2, 1, "f"): (6, None),
        (3, 1, "z"): (2, None),
        (4, 2, "gone"): (1, 2),
        (4, 1, "y"): (1, None),
        (9, 1, "w"): (None, None),
    }


def test_windows_as_written(log):
    found = windows(log, "as_written")
    assert found[(1, 1, "a")] == (1, 1)
    assert found[(1, 1, "b")] == (2, 1)
    assert found[(1, 1, "c")] == (2, None)
    assert found[(2, 1, "n")] == (1, 1)
    assert found[(2, 1, "f")] == (2, None)
    assert found[(3, 1, "z")] == (2, None)
    assert len(found) == 9


def test_unknown_rule(log):
    with pytest.raises(ValueError):
        validity_windows(*log, "e", "slot", "t", rule="other")


# ---- incremental ---------------------------------------------------------------------------------


def test_keyed_replace_with_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, v string")
    batch = spark.createDataFrame([("x", 1), ("y", 1), ("z", 3)], "v string, k int")
    got = inc.keyed_replace(target, batch, ["k"])
    assert rows(got) == [(1, "x"), (1, "y"), (2, "c"), (3, "z"), (None, "n")]
    assert rows(inc.keyed_replace(target.limit(0), batch, ["k"])) == [(1, "x"), (1, "y"), (3, "z")]


def test_append_unseen_works_with_null_keys(spark):
    target = spark.createDataFrame([(1,), (None,)], "k int")
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert rows(inc.append_unseen(target, batch, ["k"])) == [(2, "b"), (2, "c")]


def test_mark_and_since(spark, tmp_path):
    df = spark.createDataFrame(
        [(datetime(2024, 1, d), d) for d in (1, 2, 3)], "ts timestamp_ntz, v int"
    )
    assert inc.high_water_mark(df, "ts") == datetime(2024, 1, 3)
    assert inc.high_water_mark(df.limit(0), "ts") is None
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    newer = inc.since(stored, "ts", datetime(2024, 1, 2))
    assert rows(newer.select("v")) == [(2,), (3,)]
    assert "GreaterThanOrEqual(ts" in newer._jdf.queryExecution().executedPlan().toString()
    assert inc.since(df, "ts", None) is df


def test_replace_batch(spark):
    target = spark.createDataFrame([("b1", 1), ("b2", 2)], "batch_id string, v int")
    again = spark.createDataFrame([("b2", 3), ("b2", 4)], "batch_id string, v int")
    assert rows(inc.replace_batch(target, again)) == [("b1", 1), ("b2", 3), ("b2", 4)]


# ---- planning ------------------------------------------------------------------------------------


def test_missing_ids(spark):
    wanted = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "id int")
    loaded = spark.createDataFrame([(1,), (None,)], "id int")
    missing = plan.missing_ids(wanted, loaded, "id")
    assert rows(missing) == [(2,), (5,)]
    assert rows(plan.next_batch(missing, "id", 1)) == [(2,)]
    assert plan.anything_to_do(missing)
    assert not plan.anything_to_do(plan.missing_ids(loaded, loaded, "id"))


def test_missing_from_range_finds_gaps(spark):
    loaded = spark.createDataFrame([(1,), (4,), (9,)], "n bigint")
    assert rows(plan.missing_from_range(loaded, "n", 1, 5)) == [(2,), (3,), (5,)]


def test_split_malformed(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":'), (3, None), (4, "[]")], "i int, payload string")
    good, bad = plan.split_malformed(df)
    assert rows(good.select("i")) == [(1,), (4,)]
    assert rows(bad.select("i")) == [(2,), (3,)]


# ---- serving -------------------------------------------------------------------------------------


def test_flag_and_semi_join_do_not_multiply(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(1, "x"), (1, "y"), (None, "x")], "k int, t string")
    assert rows(serving.with_flag(df, members, "k", "f")) == [(1, True), (2, False), (None, False)]
    assert rows(serving.having_any(df, members, "k", "t", ["x", "y"])) == [(1,)]
    assert serving.having_any(df, members, "k", "t", []) is df


def test_top_k_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 1)], "k int, m int")
    assert [r.k for r in serving.top_k(df, 3, "m", "k").collect()] == [2, 3, 4]
    assert [r.k for r in serving.top_k(df, 4, "m", "k").collect()][-1] == 1


def test_bounds_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "g string, v int")
    assert tuple(serving.value_bounds(df, "v").first()) == (1, 3)
    assert rows(serving.count_per_group(df, "g")) == [("a", 2), ("b", 1)]


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "g string, v int")
    assert rows(column_profile(df)) == [
        ("g", "string", 2, 0, "a", "b"),
        ("v", "int", 2, 1, "1", "1"),
    ]
    listed = table_columns(spark, {"t": df}).first()
    assert [(c["column"], c["type"]) for c in listed["columns"]] == [("g", "string"), ("v", "int")]
    assert sample_rows(df, 1).count() == 1
