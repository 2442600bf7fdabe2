"""Ranged reads of an in-memory database that stands for the operational one."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.sources import jdbc

T0 = datetime(2026, 1, 1)
DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def notes(spark):
    """1,000 rows over a hundred days, 2,000 in one hour, 300 at one instant, 5 without."""
    rows = [(i, T0 + timedelta(hours=2.4 * i)) for i in range(1_000)]
    rows += [(10_000 + i, T0 + timedelta(days=40, seconds=1.8 * i)) for i in range(2_000)]
    rows += [(20_000 + i, T0 + timedelta(days=70)) for i in range(300)] + [(30_000 + i, None) for i in range(5)]
    url = "jdbc:derby:memory:ranges;create=true"
    spark.createDataFrame(rows, "id int, changed timestamp").coalesce(1).write.format("jdbc").options(url=url, dbtable="notes", **DRIVER).save()
    return url, rows


def test_ranges_follow_the_rows(spark, notes):
    url, rows = notes
    bounds = jdbc.planned(spark, url, "notes", "changed", rows=250, **DRIVER)
    assert sum(n for _, n in bounds) == 3_300 and all(n <= 301 for _, n in bounds)
    assert len(bounds) < 30 and sum(T0 + timedelta(days=39) < s < T0 + timedelta(days=41) for s, _ in bounds) >= 8
    df = jdbc.ranges(spark, url, "notes", "changed", rows=250, **DRIVER)
    assert df.rdd.getNumPartitions() == len(bounds) + 1  # rows without instant are a task
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == len(bounds) + 1 and max(r["count"] for r in sizes) <= 301
    assert sorted(r["id"] for r in df.collect()) == sorted(i for i, _ in rows)


def test_mark_columns_and_filters_reach_the_source(spark, notes):
    url, rows = notes
    mark = T0 + timedelta(days=40, minutes=30)
    df = jdbc.ranges(spark, url, "notes", "changed", mark, 250, **DRIVER)
    assert sorted(r["id"] for r in df.collect()) == sorted(i for i, t in rows if t is not None and t >= mark)
    few = df.where("id < 500").select("id")
    plan = few._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "*GreaterThanOrEqual(changed" in pushed and "*LessTh" in pushed
    assert few.count() == sum(t is not None and t >= mark and i < 500 for i, t in rows)


def test_nothing_to_read(spark, notes):
    url, _ = notes
    later = T0 + timedelta(days=1_000)
    assert jdbc.planned(spark, url, "notes", "changed", later, **DRIVER) == []
    assert jdbc.ranges(spark, url, "notes", "changed", later, **DRIVER).count() == 0
    one = jdbc.ranges(spark, url, "notes", "changed", rows=10**6, **DRIVER)
    assert one.rdd.getNumPartitions() == 2 and one.count() == 3_305


def test_conditions_take_every_row_once():
    a, b = T0, T0 + timedelta(days=1)
    assert jdbc.conditions("c", [], None) == ["1 = 1"]
    assert jdbc.conditions("c", [a, b], None) == [f'"c" < {jdbc._at(b)}', f'"c" >= {jdbc._at(b)}', '"c" IS NULL']
    assert jdbc.conditions("c", [a, b], a) == [f'"c" >= {jdbc._at(a)} AND "c" < {jdbc._at(b)}', f'"c" >= {jdbc._at(b)}']
