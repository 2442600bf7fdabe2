"""The as-of join against a plain search, with cut keys, ties and nulls."""

import bisect
import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import asof

T0 = datetime(2026, 1, 1)


def plain(left, right):
    by = {}
    for k, t, seq, v in right:
        if k is not None and t is not None:
            by.setdefault(k, []).append((t, seq, v))
    out = []
    for i, k, t in left:
        own = sorted(by.get(k, []), key=lambda r: (r[0], r[1]))
        n = bisect.bisect_right([r[0] for r in own], t) if t is not None else 0
        out.append((i, k, t, *(own[n - 1][1:] if n else (None, None))))
    return sorted(map(str, out))


@pytest.mark.parametrize("rows", [10**6, 40, 3])
def test_equals_a_plain_search(spark, rows):
    rng = random.Random(rows)
    at = lambda: T0 + timedelta(minutes=rng.randrange(3_000))
    key = lambda: rng.choice(["hot"] * 8 + ["a", "b", "left only", None])
    left = [(i, key(), rng.choice([None] + [at()] * 20)) for i in range(700)] + [(5, "hot", T0)] * 3
    right = [(rng.choice(["hot"] * 8 + ["a", "b", "right only", None]), rng.choice([None] + [at()] * 20), s, rng.choice([None, float(s)])) for s in range(300)]
    right += [("burst", T0, 1_000 + s, 1.0) for s in range(200)]
    lf = spark.createDataFrame(left, "id long, k string, t timestamp")
    rf = spark.createDataFrame(right, "k string, t timestamp, seq long, v double")
    out = asof.asof_join(lf, rf, "k", "t", ["seq", "v"], "seq", rows)
    assert out.columns == ["id", "k", "t", "seq", "v"]
    assert sorted(str(tuple(r)) for r in out.collect()) == plain(left, right)


def test_a_hot_key_is_cut_and_the_large_side_shuffled_once(spark):
    lf = spark.range(20_000).selectExpr("id", "'hot' as k", "timestamp_micros(id * 1000000) as t", "repeat('x', 50) as id_text")
    rf = spark.range(500).selectExpr("'hot' as k", "timestamp_micros(id * 40000000 + 1) as t", "id as seq")
    width = asof.slice_micros(lf, rf, "k", "t", 1_000)
    assert 900 * 10**6 < width < 1_100 * 10**6
    out = asof.asof_join(lf, rf, "k", "t", ["seq"], "seq", 1_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "ArrowEval" not in plan
    told = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = [part for part in told.split("\n\n") if ") Exchange\n" in part]
    assert sum("_own" in part for part in exchanges) == 1 < len(exchanges)  # the others carry keys, slices and ends
    assert out.where("seq is null").count() == 1 and out.where("seq is not null").selectExpr("max(id - (seq * 40 + 1))").first()[0] < 40


def test_empty_sides(spark):
    lf = spark.createDataFrame([(1, "a", T0)], "id long, k string, t timestamp")
    rf = spark.createDataFrame([("a", T0, 1)], "k string, t timestamp, seq long")
    assert asof.asof_join(lf, rf.where("false"), "k", "t", ["seq"], "seq").collect()[0]["seq"] is None
    assert asof.asof_join(lf.where("false"), rf, "k", "t", ["seq"], "seq").count() == 0
    assert asof.asof_join(lf, rf, "k", "t", ["seq"], "seq").collect()[0]["seq"] == 1
