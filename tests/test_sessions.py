"""Sessions of a stream over several batches, with late rows and restarts."""

from datetime import datetime, timedelta

import pytest

from tidemark.streaming import ingest
from tidemark.streaming.sessions import Sessions, sessions_of

SCHEMA = "k string, ts timestamp, v double"
DAY = datetime(2026, 1, 5)


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def gaps_and_islands(rows, gap=30):
    out = {}
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k and r[1] is not None), key=lambda r: r[1])
        islands = []
        for r in own:
            if islands and r[1] - islands[-1][-1][1] <= timedelta(minutes=gap):
                islands[-1].append(r)
            else:
                islands.append([r])
        for i in islands:
            out[k, i[0][1]] = (i[-1][1] + timedelta(minutes=gap), len(i), sum(r[2] for r in i))
    return out


def told(df):
    return {(r["k"], r["session_start"]): (r["session_end"], r["n"], r["total"]) for r in df.collect()}


@pytest.fixture
def arrive(spark, tmp_path):
    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")

    made = Sessions(f"file://{tmp_path}/run", ("k",), "ts", "v", "30 minutes", "60 minutes")
    return land, made, lambda: made.run(ingest.landed(spark, f"{tmp_path}/landed", SCHEMA, 1))


def test_sessions_grow_merge_close_and_survive_restarts(spark, arrive):
    land, made, run = arrive
    first = [("a", at(0), 1.0), ("a", at(20), 2.0), ("b", at(0), 4.0), (None, at(10), 8.0), ("a", at(100), 16.0), ("x", None, 1.0)]
    land(first)
    assert run() == {"rows": 6, "dropped": 0}
    # the watermark is 40 minutes: b's session ended at 30 and a null key's at 40, a's first ends at 50
    assert set(told(made.closed(spark))) == {("b", at(0)), (None, at(10))}
    assert set(told(made.open(spark))) == {("a", at(0)), ("a", at(100))}
    assert run()["rows"] == 0  # nothing new, nothing twice
    second = [("a", at(45), 32.0), ("a", at(72), 64.0), ("c", at(300), 1.0)]  # late rows join both sessions of a
    land(second)
    assert run()["dropped"] == 0
    want = gaps_and_islands(first + second)
    assert told(made.all(spark)) == want and told(made.open(spark)).keys() == {("c", at(300))}
    assert want["a", at(0)] == (at(130), 5, 115.0)
    land([("b", at(10), 1.0), ("c", at(290), 2.0)])  # b's time is closed, c's isn't
    assert run() == {"rows": 2, "dropped": 1}
    assert told(made.all(spark)) == gaps_and_islands([*first, *second, ("c", at(290), 2.0)])


def test_stream_equals_table_and_borders_join(spark, arrive):
    land, made, run = arrive
    rows = [("a", at(0), 1.0), ("a", at(30), 1.0), ("a", at(60), 1.0), ("b", at(0), 1.0), ("b", at(0), 1.0), ("b", at(30) + timedelta(microseconds=1), 1.0)]
    for r in rows:
        land([r])
    run()
    table = spark.createDataFrame(rows, SCHEMA)
    assert told(made.all(spark)) == told(sessions_of(table, ["k"], "ts", "v", "30 minutes")) == gaps_and_islands(rows)
