"""Top k over a join: the best candidates first, and more of them where few find a partner."""

import random

import pytest

from layerwright.operators.serving import top_k, top_k_joined


def plain(df, partners, k):
    return [tuple(r) for r in top_k(df.join(partners, "p"), k, "v", "k").select("k", "v", "w").collect()]


@pytest.mark.parametrize("known", [lambda k: True, lambda k: k % 3 == 0, lambda k: k > 1900, lambda k: False])
@pytest.mark.parametrize("draw", [lambda r: r.random(), lambda r: r.choice([1.0, 2.0, None]), lambda r: None])
def test_same_rows_as_joining_all(spark, known, draw):
    rng = random.Random(1)
    rows = [(k, draw(rng), k) for k in range(2000)]
    # without a partner: by default the best ones, where the measures are spread
    best = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    df = spark.createDataFrame([(k, v, place) for place, (k, v, _) in enumerate(best)], "k int, v double, p int")
    partners = spark.createDataFrame([(p, f"w{p}") for p in range(2000) if known(p)], "p int, w string")
    asked = []

    def join(frame):
        asked.append(frame)
        return frame.join(partners, "p").select("k", "v", "w")

    found = [tuple(r) for r in top_k_joined(df, 5, "v", "k", join).collect()]
    assert found == plain(df, partners, 5)
    if known(0) and known(1):
        assert len(asked) == 1 and asked[0].count() == 20


def test_rows_repeated_by_the_join(spark):
    df = spark.range(500).selectExpr("id AS k", "id AS v", "id % 7 AS p")
    partners = spark.createDataFrame([(3, "a"), (3, "b"), (5, "c")], "p long, w string")
    found = top_k_joined(df, 6, "v", "k", lambda rows: rows.join(partners, "p").select("k", "v", "w")).collect()
    expected = top_k(df.join(partners, "p"), 6, "v", "k").collect()
    assert sorted((r.k, r.v) for r in found) == sorted((r.k, r.v) for r in expected)
    assert top_k_joined(df.limit(0), 6, "v", "k", lambda rows: rows.join(partners, "p")).collect() == []
