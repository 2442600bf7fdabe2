"""The lease of the daily run: expiry, take-over, fencing."""

import threading
import time

import pytest

from tidemark.operators.store import Store
from tidemark.plans import tasks
from tidemark.plans.lease import Fenced, Held, Lease
from tidemark.schema import TABLES


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/lake", buckets=2)


def test_one_at_a_time_and_free_after_release(store):
    with Lease(store, "x", 60).held() as first:
        with pytest.raises(Held, match="under way"):
            Lease(Store(store.spark, store.root), "x", 60).take()
        assert Lease(store, "y", 60).take() == 1  # another name, another lease
    assert Lease(store, "x", 60).take() == first + 1
    assert store.guard is None


def test_heartbeats_keep_it_and_a_dead_run_is_taken_over(store):
    with Lease(store, "x", 0.9).held():
        time.sleep(2)
        with pytest.raises(Held):
            Lease(store, "x", 0.9).take()
    dead = Lease(store, "x", 0.5)
    dead.take()  # a run that was killed: no heartbeat, no release
    time.sleep(0.7)
    heir = Lease(store, "x", 0.5)
    assert heir.take() == dead.epoch + 1
    heir.check()
    with pytest.raises(Fenced):
        dead.check()
    dead.release()
    with pytest.raises(Held):  # the dead run's release doesn't free the heir's lease
        Lease(store, "x", 60).take()


def test_of_many_contenders_one_gets_it(store):
    Lease(store, "x", 60)
    got = []

    def contend():
        try:
            got.append(Lease(store, "x", 60).take())
        except Held:
            got.append(None)

    threads = [threading.Thread(target=contend) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(x for x in got if x) == [1] and len(got) == 6


def test_a_late_write_of_a_stalled_run_is_refused(spark, store):
    table = TABLES["bronze.ingestion_runs"]
    store.create(table)
    other, ran = Store(spark, store.root, buckets=2), []
    row = lambda k: spark.createDataFrame([(k, "t", None, None, "succeeded", 0, None)], table.schema)

    def stalled(_, conf):
        ran.append("stalled")
        # the run is taken for dead while it stalls: another one takes over and writes
        files = Lease(other, "daily", 0.0)
        files.take()
        other.upsert(table, row("heir"))
        return store.upsert(table, row("late"))

    jobs = {n: stalled if n == "ingest_prices" else (lambda *_, n=n: ran.append(n) or 0) for n, _, _ in tasks.DAILY}
    with pytest.raises(Fenced):
        tasks.run_daily(jobs, spark, {}, store, with_optional=True)
    assert ran == ["stalled"]  # neither tried again nor followed by other tasks
    assert {r["run_id"] for r in store.read(table).collect()} == {"heir"}
