"""The vector index against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import vectors


def brute(rows, queries, k):
    unit = {i: np.asarray(v) / np.linalg.norm(v) for i, v in rows}
    return {q: [i for _, i in sorted((-round(float((unit[q] * u).sum()), 12), i) for i, u in unit.items() if i != q)[:k]] for q in queries}


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=8) * 0.3).tolist()) for i in range(1_200)]
    rows += [(2_000 + i, rows[5][1]) for i in range(300)]  # a hot list of copies
    odd = [(3_000, None), (3_001, [0.0] * 8), (3_002, [float("nan")] + [1.0] * 7), (3_003, [None] + [1.0] * 7), (None, [1.0] * 8), (3_004, [])]
    df = spark.createDataFrame(rows + odd, "doc_id long, embedding array<double>").repartition(5)
    patch = pytest.MonkeyPatch()
    patch.setattr(vectors, "BLOCK", 64)  # blocks are cut on the driver's side of the plan
    path = f"file://{tmp_path_factory.mktemp('vectors')}/index"
    yield rows, df, vectors.build(df, path, lists=12), path
    patch.undo()


def test_exact_equals_brute_force_and_skips_blocks(spark, clustered):
    rows, df, index, _ = clustered
    asked = df.where("doc_id % 25 = 0 or doc_id = 2007")
    want = brute(rows, [i for i, _ in rows if i % 25 == 0 or i == 2007], 5)
    first = vectors.probed(index, asked, 5, 1)
    found = vectors.exact(index, asked, 5, 1).collect()
    assert {q: [r["doc_id"] for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])] for q in want} == want
    assert len(found) == 5 * len(want)
    pairs = vectors.blocks_to_compare(index, asked, first, 5).count()
    assert pairs < 0.5 * index.blocks.count() * len(want)
    assert index.blocks.agg(F.max("n")).first()[0] <= 64 and index.posted.count() == len(rows)


def test_probes_reach_the_recall_that_was_asked_for(spark, clustered):
    rows, df, index, path = clustered
    asked = df.where("doc_id % 10 = 3")
    assert 1 <= vectors.load(spark, path).probes == index.probes <= 6
    assert vectors.recall(vectors.probed(index, asked), vectors.exact(index, asked)) >= 0.9
    assert index.nearest_lists(rows[0][1], 1)[0] == index.posted.where("doc_id = 0").first()["list"]
    plan = index.posted.where(F.col("list").isin(index.nearest_lists(rows[0][1], 2)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(list" in plan


def test_exact_needs_no_calibration_and_lengths_are_added_up_once(spark, clustered, tmp_path):
    rows, df, _, _ = clustered
    plan = df.select(vectors.unit(F.col("embedding")))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "aggregate(" in plan and "/ sqrt(" not in plan  # the length isn't part of what is done for each component
    index = vectors.build(df, f"file://{tmp_path}/plain", lists=12, recall_target=None)
    asked = df.where("doc_id % 100 = 0")
    want = brute(rows, [i for i, _ in rows if i % 100 == 0], 5)
    found = sorted((r["query_id"], r["rank"], r["doc_id"]) for r in vectors.exact(index, asked).collect())
    assert found == sorted((q, k + 1, i) for q, ids in want.items() for k, i in enumerate(ids))
    assert index.probes == len(index.centres)


def test_few_vectors_and_none(spark, tmp_path):
    empty = spark.createDataFrame([(1, None)], "doc_id long, embedding array<float>")
    index = vectors.build(empty, f"file://{tmp_path}/none")
    assert vectors.probed(index, empty).count() == vectors.exact(index, empty).count() == 0
    few = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("c", [0.0, 1.0]), ("c", [1.0, 1.0])], "doc_id string, embedding array<double>")
    index = vectors.build(few, f"file://{tmp_path}/few")
    out = sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 6)) for r in vectors.exact(index, few, 3).collect())
    assert out == [("a", 1, "b", 1.0), ("a", 2, "c", 0.707107), ("a", 3, "c", 0.0), ("b", 1, "a", 1.0), ("b", 2, "c", 0.707107), ("b", 3, "c", 0.0), ("c", 1, "a", 0.707107), ("c", 2, "b", 0.707107), ("c", 3, "a", 0.0)]
