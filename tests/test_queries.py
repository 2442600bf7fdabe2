"""Every query against the SQL that says the same, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in NAMES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return plain(v.item())
    return [plain(x) for x in v] if isinstance(v, list | tuple) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((str([plain(r[i]) for i in order]) for r in data))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(spark, name):
    sf = SF.replace("0.001", "0.01") if name == "m14_backtest" else SF
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and out.columns[:2] == ["ticker", "trade_date"]


def test_feature_plan_prunes_columns(spark):
    plan = entry.queries()["features_daily"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_clerk" not in plan and "l_extendedprice" not in plan
    assert "CartesianProduct" not in plan and "ArrowEvalPython" not in plan


def test_nothing_outside_imports_the_corpus_package():
    root = Path(entry.__file__).parent
    for p in (root / "tidemark").rglob("*.py"):
        if "llm" not in p.parts:
            assert "tidemark.llm" not in p.read_text() and "corpus_pipeline" not in p.read_text(), p
