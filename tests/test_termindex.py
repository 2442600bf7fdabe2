"""The term index against scoring every document."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge, search, termindex

WORDS = ["the"] * 40 + ["and"] * 20 + [f"w{i}" for i in range(30)]


def corpus(n, seed=1):
    rng = random.Random(seed)
    out = [(i, " ".join([rng.choice(WORDS) for _ in range(rng.randrange(1, 90))] + ["rare"] * (i % 90 == 7))) for i in range(n)]
    return out + [(9_000, "rare rare rare w1"), (9_001, "Rare, the"), (9_002, None), (9_003, ""), (None, "rare")] + [(8_000 + i, "w1 the the and") for i in range(200)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def brute(df, query, k):
    scores = search.bm25(df.where("doc_id is not null"), query)
    return [(r["doc_id"], r["score"]) for r in scores.select("doc_id", F.round("score", 10).alias("score")).orderBy(F.desc("score"), "doc_id").limit(k).collect()]


def found(spark, path, query, k):
    out = termindex.search(spark, path, query, k)
    return [(r["doc_id"], r["score"]) for r in out.rows.collect()], out


def same(got, want):
    assert [d for d, _ in got] == [d for d, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-9)


@pytest.fixture(scope="module")
def small_windows():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(termindex, "WINDOW", 16)
        patch.setattr(termindex, "FIRST", 3)
        yield


def test_best_equal_scoring_all_and_blocks_are_skipped(spark, tmp_path, small_windows, monkeypatch):
    rows, path = corpus(1_500), f"file://{tmp_path}/index"
    df = frame(spark, rows).cache()
    termindex.build(df, path)
    shares = {}
    for query, k in ((["the", "and"], 10), (["rare", "the", "w3"], 5), (["w1"], 250), (["rare"], 20), (["nowhere"], 5), ([], 3)):
        got, out = found(spark, path, query, k)
        same(got, brute(df, query, k))
        shares[" ".join(query)] = (out.read, out.blocks)
    assert 0 < shares["rare the w3"][0] < 0.5 * shares["rare the w3"][1]
    assert shares["nowhere"] == shares[""] == (0, 0)
    monkeypatch.setattr(termindex, "NAMED", 1)
    same(found(spark, path, ["rare", "the", "w3"], 5)[0], brute(df, ["rare", "the", "w3"], 5))
    largest = spark.read.parquet(f"{path}/blocks").agg(F.max(F.size("entries"))).first()[0]
    assert largest < 60  # the 200 copies lie in many windows
    plan = termindex._read(spark, path, "blocks", [0]).where(F.col("term").isin(["the"])).groupBy("window").agg(F.max("most_tf"))._jdf.queryExecution().executedPlan().toString()
    assert "In(term" in plan or "EqualTo(term" in plan
    assert "entries" not in plan


def test_changes_keep_the_index(spark, tmp_path, small_windows):
    rows, path = corpus(300), f"file://{tmp_path}/index"
    termindex.build(frame(spark, rows), path)
    rng, now = random.Random(9), dict(r for r in rows if r[0] is not None)
    for step in range(2):
        after = {i: t for i, t in now.items() if rng.random() > 0.2}
        after |= {i: f"{t or ''} rare w{step}" for i, t in after.items() if rng.random() < 0.2}
        after |= {10_000 + 100 * step + j: "rare and new " + "w5 " * j for j in range(20)} | {1: "back again rare"}
        feed = merge.change_feed(frame(spark, list(now.items())), frame(spark, list(after.items())), ["doc_id"])
        assert termindex.sync_changes(spark, path, feed) == step + 1
        now = after
    df = frame(spark, list(now.items())).cache()
    # a segment that was cut off before its totals doesn't count
    termindex._read(spark, path, "blocks", [0]).limit(5).write.parquet(f"{path}/blocks/seg=7")
    to = f"file://{tmp_path}/compact"
    termindex.compacted(spark, path, to)
    for query, k in ((["rare", "w5"], 15), (["the", "new", "back"], 10)):
        want = brute(df, query, k)
        same(found(spark, path, query, k)[0], want)
        same(found(spark, to, query, k)[0], want)


def test_tasks_follow_the_texts(spark, tmp_path, monkeypatch):
    """A document's terms are counted in its row, and no task takes more than its share, however few partitions a session has."""
    monkeypatch.setattr(termindex, "TEXT", 4_000)
    monkeypatch.setattr(termindex, "ENTRIES", 500)
    rows, path = corpus(400), f"file://{tmp_path}/index"
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        termindex.build(frame(spark, rows), path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before["spark.sql.shuffle.partitions"])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before["spark.sql.files.maxPartitionBytes"]
    held = spark.read.parquet(f"{path}/blocks").groupBy(F.input_file_name()).agg(F.sum(F.size("entries")).alias("n"))
    files, largest = held.agg(F.count("*"), F.max("n")).first()
    assert files > 4 and largest < 1_500
    got = {(r["term"], r["doc_id"]): (r["tf"], r["n"]) for r in spark.read.parquet(f"{path}/blocks").select("term", F.inline("entries")).collect()}
    want = {(r["term"], r["doc_id"]): (r["tf"], r["n"]) for r in search.postings(frame(spark, rows).where("doc_id is not null")).collect()}
    assert got == want


def test_tasks_of_a_sync_follow_the_texts(spark, tmp_path, monkeypatch):
    """A feed's documents, gone and new, are dealt by their texts, and a segment's blocks by its entries."""
    monkeypatch.setattr(termindex, "TEXT", 4_000)
    monkeypatch.setattr(termindex, "ENTRIES", 500)
    rows, path = corpus(300), f"file://{tmp_path}/index"
    was, now = frame(spark, rows[:200]), frame(spark, [(i, f"{t} new") for i, t in rows[150:] if i is not None])
    termindex.build(was, path)
    termindex.sync_changes(spark, path, merge.change_feed(was, now, ["doc_id"]))
    held = spark.read.parquet(f"{path}/blocks/seg=1").groupBy(F.input_file_name()).agg(F.sum(F.size("entries")).alias("n"))
    files, largest = held.agg(F.count("*"), F.max("n")).first()
    assert files > 4 and largest < 1_500
    assert spark.read.parquet(f"{path}/bags/seg=1").select(F.input_file_name()).distinct().count() > 4
    same(found(spark, path, ["new", "rare", "the"], 9)[0], brute(now, ["new", "rare", "the"], 9))


def test_snapshots_and_counts_follow_the_texts(spark, tmp_path, monkeypatch):
    """With two partitions in the session, snapshots are compared and counts added up in as many tasks as texts and entries ask for."""
    monkeypatch.setattr(termindex, "TEXT", 4_000)
    monkeypatch.setattr(termindex, "ENTRIES", 500)
    rows, path = corpus(300), f"file://{tmp_path}/index"
    rows += [(20_000 + i, " ".join(f"t{i}x{j}" for j in range(10))) for i in range(100)]
    was, now = frame(spark, rows[:250]), frame(spark, [(i, f"{t} new") for i, t in rows[200:]])
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        feed = termindex.change_feed(was, now)
        parts = [r["n"] for r in feed.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("text")).alias("n")).collect()]
        termindex.build(was, path)
        termindex.sync_changes(spark, path, feed)
        termindex.compacted(spark, path, f"{path}_compact")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == held["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    finally:
        for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.set(k, held[k])
    assert len(parts) > 8 and max(parts) < 16_000
    assert sorted(feed.collect()) == sorted(merge.change_feed(was.where("doc_id is not null"), now.where("doc_id is not null"), ["doc_id"]).collect())
    for at in (f"{path}/counts/seg=1", f"{path}_compact/counts/seg=0"):
        assert spark.read.parquet(at).select(F.input_file_name()).distinct().count() > 4
    for to in (path, f"{path}_compact"):
        same(found(spark, to, ["new", "rare", "the", "t7x3"], 9)[0], brute(now, ["new", "rare", "the", "t7x3"], 9))


def test_index_of_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    termindex.build(frame(spark, [(None, "a")]), path)
    assert found(spark, path, ["a"], 3)[0] == []
    termindex.sync(spark, path, frame(spark, [(5, "x")]).where("false"), frame(spark, [(1, "a b"), (2, "b")]))
    assert [d for d, _ in found(spark, path, ["a"], 3)[0]] == [1]
