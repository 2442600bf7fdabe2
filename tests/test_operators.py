"""Closed forms, goldens, stores, regimes, simulation, services, streams."""

import json
import uuid
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import exchange, numeric, text, timeops
from tidemark.operators import features, merge, regime, search, simulate
from tidemark.operators.store import Conflict, Store
from tidemark.plans import forecasts, tasks
from tidemark.schema import TABLES, Table
from tidemark.sources import client, tables
from tidemark.streaming import ingest

T = Table("t", "k bigint, v string", ("k",))


# Dates, instants and scores below are golden values (fixed), as are the parameters of the two-regime series.
# -- calendar and instants --------------------------------------------------------------
@pytest.mark.parametrize(("day", "session"), [("2026-04-03", "2026-04-06"), ("2026-07-03", "2026-07-06"), ("2026-01-19", "2026-01-20"), ("2026-11-26", "2026-11-27")])
def test_next_session_goldens(spark, day, session):
    d = date.fromisoformat(day)
    out = dict(map(tuple, exchange.next_session(spark, d - timedelta(5), d + timedelta(5)).collect()))
    assert out[d] == date.fromisoformat(session)


def test_sessions_of_known_years():
    count = lambda y: len(exchange.sessions(date(y, 1, 1), date(y, 12, 31)))
    assert [count(y) for y in (1999, 2001, 2020, 2022, 2024, 2025)] == [252, 248, 253, 251, 252, 250]
    assert date(2022, 1, 3) in exchange.sessions(date(2021, 12, 31), date(2022, 1, 3)) and date(2021, 12, 31) in exchange.sessions(date(2021, 12, 31), date(2021, 12, 31))


@pytest.mark.parametrize(("instant", "session"), [("2026-03-09 04:00:00", "2026-03-09"), ("2026-03-06 05:00:00", "2026-03-06"), ("2026-11-02 04:00:00", "2026-11-01")])
def test_session_date_across_clock_changes(spark, instant, session):
    assert spark.range(1).select(timeops.session_date(F.lit(instant).cast("timestamp"))).first()[0] == date.fromisoformat(session)


def test_epoch_millis_goldens(spark):
    for ms, day in ((1782878400000, "2026-07-01"), (1782964800000, "2026-07-02"), (1783310400000, "2026-07-06")):
        assert str(spark.range(1).select(timeops.session_date(timeops.instant_of_millis(F.lit(ms)))).first()[0]) == day


def test_text_functions(spark):
    row = spark.range(1).select(
        text.redacted(F.lit("u?apiKey=SECRET&x=1")).alias("a"), text.normal_ticker(F.lit(" brk.b")).alias("b"), text.normal_ticker(F.lit("tesla stock")).alias("c"),
        text.embedding_text(F.lit(" "), F.lit("d")).alias("d"), text.surrogate_id(str(uuid.NAMESPACE_URL), F.lit("NVDA|2026-01-02|gbm")).alias("e"),
        text.snippet(F.lit("Title\nBody " + "x" * 400), F.lit("Title")).alias("f"), numeric.volume_to_long(F.lit(2.5)).alias("g"), numeric.percent(F.lit(float("nan"))).alias("h")).first()
    assert (row.a, row.b, row.c, row.d, row.g, row.h) == ("u?apiKey=***REDACTED***&x=1", "BRK.B", None, "d", 3, "—")
    assert row.e == str(uuid.uuid5(uuid.NAMESPACE_URL, "NVDA|2026-01-02|gbm"))
    assert row.f.startswith("Body") and row.f.endswith("...") and len(row.f) == 323


@pytest.mark.parametrize(("p", "r", "want"), [(0.7, 0.1, 0.09), (0.7, -0.1, 0.49), (0.5, 0.1, 0.25), (1.0, 0.1, 0.0), (1.0, -0.1, 1.0), (1.0, 0.0, 1.0)])
def test_brier(spark, p, r, want):
    assert spark.range(1).select(numeric.brier(F.lit(p), F.lit(r))).first()[0] == pytest.approx(want)


def test_verdict_depends_on_n(spark):
    said = lambda a, b, n: spark.range(1).select(numeric.verdict(F.lit(a), F.lit(b), F.lit(n))).first()[0]
    assert [said(.18, .25, 255), said(.25, .18, 255), said(.247, .25, 255), said(.22, .25, 30), said(.22, .25, 3000)] == ["better", "worse", "indistinguishable", "indistinguishable", "better"]


# -- features ---------------------------------------------------------------------------
def made_features(spark, closes, volumes=None, news=()):
    days = exchange.sessions(date(2025, 1, 2), date(2026, 1, 1))[:len(closes)]
    bars = spark.createDataFrame([("A", d, float(c) if c is not None else None, int(v)) for d, c, v in zip(days, closes, volumes or [100] * len(closes), strict=True)], "ticker string, trade_date date, close double, volume bigint")
    rows = spark.createDataFrame([("A", days[i], s) for i, s in news], "ticker string, news_date date, sentiment_score int")
    cal = exchange.sessions_frame(spark, days[0], days[-1])
    return features.daily_features(bars, rows, cal, exchange.next_session(spark, days[0], days[-1])).orderBy("trade_date").toPandas()


def test_feature_closed_forms(spark):
    out = made_features(spark, [100 * 1.01 ** i for i in range(30)])
    assert out["log_return"].iloc[1] == pytest.approx(np.log(1.01)) and out["return_5d"].iloc[5] == pytest.approx(1.01 ** 5 - 1)
    assert out["momentum_5d"].iloc[5] == pytest.approx(5 * np.log(1.01)) and out["realized_vol_20d"].iloc[20] == pytest.approx(0, abs=1e-9)
    first = {c: out[c].first_valid_index() for c in ("return_5d", "momentum_5d", "realized_vol_20d")}
    assert first == {"return_5d": 5, "momentum_5d": 5, "realized_vol_20d": 20} and out["volume_zscore_20d"].isna().all()


def test_volume_zscore_and_bad_prices(spark):
    out = made_features(spark, [100, 101, None, 103, 0, 105, 106, 107, 108, 109, *range(110, 122)], [*[100] * 19, 200, 100, 100])
    assert out["volume_zscore_20d"].iloc[19] == pytest.approx(4.2485291572)
    assert out["log_return"].iloc[[2, 3, 4, 5]].isna().all() and np.isfinite(out["log_return"].iloc[6])


def test_news_decay_and_roll_forward(spark):
    out = made_features(spark, [100] * 4, news=[(0, 1)])
    assert out["news_sentiment_3d"].tolist() == pytest.approx([1 / 1.75, .5 / 1.75, .25 / 1.75, 0])
    bars = spark.createDataFrame([("A", date(2026, 8, 10), 1.0, 1)], "ticker string, trade_date date, close double, volume bigint")
    week = [("A", date(2026, 8, 8), 1), ("A", date(2026, 8, 9), -1), ("A", date(2026, 8, 10), 1)]
    rows = spark.createDataFrame(week, "ticker string, news_date date, sentiment_score int")
    got = features.daily_features(bars, rows, exchange.sessions_frame(spark, date(2026, 8, 3), date(2026, 8, 10)), exchange.next_session(spark, date(2026, 8, 3), date(2026, 8, 10))).first()
    assert got["news_count"] == 3 and got["news_sentiment"] == pytest.approx(1 / 3)


# -- merges and stores ------------------------------------------------------------------
@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.text("ab", max_size=2))), st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.text("ab", max_size=2))))
def test_feed_rebuilds_the_table(spark, old, new):
    a, b = (spark.createDataFrame(list(d.items()), T.schema) for d in (old, new))
    feed = merge.change_feed(a, b, T.keys)
    assert dict(map(tuple, merge.applied(a, feed, T.keys).collect())) == new
    assert {r["k"] for r in feed.collect()} == {k for k in old.keys() | new.keys() if k not in old or k not in new or old[k] != new[k]}
    assert dict(map(tuple, merge.upserted(a, b, T.keys).collect())) == old | new
    assert dict(map(tuple, merge.with_absent(a, b, T.keys).collect())) == new | old


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/tables", buckets=4)
    with pytest.raises(LookupError):
        store.read(T)
    frame = lambda d: spark.createDataFrame(list(d.items()), T.schema)
    assert store.upsert(T, frame({i: "a" for i in range(20)})) == 20
    assert store.upsert(T, frame({})) == 0
    before = set(store._manifest("t", store.versions("t")[-1])["buckets"].values())
    assert store.upsert(T, frame({3: "b"})) == 1
    after = set(store._manifest("t", store.versions("t")[-1])["buckets"].values())
    assert len(before - after) == 1  # only the touched bucket was written anew
    assert dict(map(tuple, store.read(T).collect())) == {i: "a" for i in range(20)} | {3: "b"}
    v = store.versions("t")
    assert [tuple(r) for r in store.changes(T, v[-2]).orderBy("change_type").collect()] == [(3, "update_post", "b"), (3, "update_pre", "a")]
    with pytest.raises(merge.DuplicateKeys):
        store.upsert(T, spark.createDataFrame([(1, "x"), (1, "y")], T.schema))
    with pytest.raises(ValueError, match="missing"):
        store.upsert(T, spark.createDataFrame([(1,)], "k bigint"))
    with pytest.raises(Conflict):
        store._commit("t", v[-1] - 1, {})
    store.insert_absent(T, frame({3: "no", 50: "new"}))
    store.delete_keys(T, spark.createDataFrame([(k,) for k in range(3)], "k bigint"))
    assert dict(map(tuple, store.read(T).where("k in (0, 3, 50)").collect())) == {3: "b", 50: "new"}
    assert store.read(T, v[0]).count() == 0


D = Table("d", "k bigint, day date, v string", ("k",))


def test_store_grows_and_keeps_floors(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/tables", buckets=2, bucket_bytes=1)
    frame = lambda ks, v: spark.createDataFrame([(k, None if k == 7 else date(2026, 1, 1 + k % 28), v) for k in ks], D.schema)
    store.upsert(D, frame(range(60), "a"))
    store.bucket_bytes = store._current("d")["bytes"] // 5
    store.upsert(D, frame([1], "b"))  # two buckets are too few now
    assert store._current("d")["n"] == 8 and len(store._current("d")["buckets"]) == 8
    store.bucket_bytes = 1 << 40
    before = store._current("d")["buckets"]
    store.retain(D, "day", date(2026, 1, 15))
    assert store._current("d")["buckets"] == before  # no data was written
    held = {r["k"] for r in store.read(D).collect()}
    assert held == {k for k in range(60) if k == 7 or k % 28 >= 14}
    store.upsert(D, frame([2], "old row that comes later"))
    assert {r["k"] for r in store.read(D).collect()} == held | {2}
    store.retain(D, "day", date(2026, 1, 10))  # a lower floor brings nothing back
    assert {r["k"] for r in store.read(D).collect()} == held
    versions = store.versions("d")
    feed = store.changes(D, versions[-3])
    assert sorted((r["change_type"], r["k"]) for r in feed.collect()) == []
    gone = sorted((r["change_type"], r["k"]) for r in store.changes(D, versions[-4], versions[-3]).collect())
    assert gone == sorted(("delete", k) for k in range(60) if k not in held)
    untouched = store._current("d")["buckets"]
    store.delete_keys(D, spark.createDataFrame([(59,)], "k bigint"))
    store.insert_absent(D, frame([59, 1000], "c"))
    assert len(set(untouched.values()) - set(store._current("d")["buckets"].values())) <= 2
    assert {r["k"]: r["v"] for r in store.read(D).where("k >= 59").collect()} == {59: "c", 1000: "c"}
    rows = sorted(map(tuple, store.read(D).collect()), key=str)
    assert store.vacuum(D, keep=1, hours=0) > 0 and store.vacuum(D, keep=1, hours=0) == 0
    assert len(store.versions("d")) == 1 and sorted(map(tuple, store.read(D).collect()), key=str) == rows


def test_a_writer_that_loses_starts_again(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/tables", buckets=2)
    frame = lambda d: spark.createDataFrame(list(d.items()), T.schema)
    store.upsert(T, frame({1: "a"}))
    other, commit, once = Store(spark, store.root, buckets=2), store._commit, []

    def late(*args, **more):
        if not once:
            once.append(other.upsert(T, frame({2: "b"})))
        return commit(*args, **more)

    monkeypatch.setattr(store, "_commit", late)
    store.upsert(T, frame({3: "c"}))
    assert dict(map(tuple, store.read(T).collect())) == {1: "a", 2: "b", 3: "c"}


def test_retention_keeps_nulls(spark):
    df = spark.createDataFrame([(1, date(2026, 1, 1)), (2, None), (3, date(2026, 2, 1))], "k int, d date")
    assert [r.k for r in merge.retained(df, "d", F.lit(date(2026, 1, 15))).orderBy("k").collect()] == [2, 3]


def test_stream_is_an_upsert(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/tables")
    src = f"{tmp_path}/landed"
    for part in ([(1, "a", 1), (2, "b", 2)], [(1, "late", 0), (1, "c", 3)]):
        spark.createDataFrame(part, "k bigint, v string, seq int").coalesce(1).write.mode("append").parquet(src)
        for _ in range(2):  # a replay changes nothing
            ingest.upsert_stream(ingest.landed(spark, src, "k bigint, v string, seq int"), store, T, "seq", f"{tmp_path}/cp").awaitTermination()
    assert dict(map(tuple, store.read(T).collect())) == {1: "c", 2: "b"}


def test_stream_counts_equal_batch(spark, tmp_path):
    events = spark.createDataFrame([(datetime(2026, 1, 1 + i % 3, i % 24), "ab"[i % 2], float(i)) for i in range(40)], "ts timestamp, kind string, value double")
    events.write.parquet(f"{tmp_path}/e")
    stream = ingest.tumbling_counts(ingest.landed(spark, f"{tmp_path}/e", events.schema), "ts", "kind", "value")
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, ingest.tumbling_counts(events, "ts", "kind", "value").collect()))
    assert ingest.deduplicated(ingest.landed(spark, f"{tmp_path}/e", events.schema), ["kind"], "ts").isStreaming


# -- regimes ----------------------------------------------------------------------------
def chain(n=800, seed=20_260_810):
    rng = np.random.default_rng(seed)
    s = np.zeros(n, int)
    for t in range(1, n):
        s[t] = s[t - 1] if rng.random() < 0.96 else 1 - s[t - 1]
    return s, np.array([.05, -.15])[s] + np.array([1.0, 3.0])[s] * rng.standard_normal(n), np.clip(-.6 * s + .3 * rng.standard_normal(n), -1, 1)


def test_regimes_are_recovered():
    s, y, x = chain()
    for f in (regime.fit(y), regime.fit(y[1:], x[:-1])):
        assert f.sigma == pytest.approx([1, 3], rel=0.25) and np.allclose(f.transition.sum(axis=0), 1)
        assert ((f.filtered[:, 1] > .5) == (s[len(s) - f.n_obs:] == 1)).mean() > 0.8
        assert f.current.sum() == pytest.approx(1)
    again = regime.fit(y)
    assert (again.mu == regime.fit(y).mu).all() and again.loglik == regime.fit(y).loglik


def test_gradient_is_the_likelihoods(monkeypatch):
    _, y, x = chain(200)
    for z in (np.column_stack([np.ones(200), x]), np.column_stack([np.ones(200), np.zeros(200)])):
        at = np.array([0.1, -0.3, np.log(0.9), np.log(2.2), 1.5, 0.4, -1.2, -0.7])
        value = lambda t: regime.gradient(y, z, t[:2], np.exp(t[2:4]), t[4:].reshape(2, 2))
        steps = np.eye(8) * 1e-5
        assert value(at)[1] == pytest.approx([(value(at + h)[0] - value(at - h)[0]) / 2e-5 for h in steps], abs=2e-4)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_polish_never_lowers_the_likelihood(monkeypatch, seed):
    _, y, x = chain(400, seed)
    for exog in (None, x):
        polished = regime.fit(y, exog, starts=4)
        z = np.column_stack([np.ones(400), np.zeros(400) if exog is None else exog])
        value, slope = regime.gradient(y, z, polished.mu, polished.sigma, polished.beta)
        assert value == pytest.approx(polished.loglik) and np.abs(slope[np.r_[[True] * 4, np.abs(polished.beta.ravel()) < regime.LOGIT]]).max() / 400 <= 2 * regime.GRADIENT
        with monkeypatch.context() as patch:
            patch.setattr(regime, "polish", lambda y, z, mu, sigma, beta, floor: (mu, sigma, beta, 0.0, np.inf))
            plain = regime.fit(y, exog, starts=4)
        assert polished.loglik >= plain.loglik and polished.converged
        with monkeypatch.context() as patch:  # it also ends where a rough start of few steps began
            patch.setattr(regime, "LAST_STEPS", 2)
            assert regime.fit(y, exog, starts=4).loglik == pytest.approx(polished.loglik, abs=1e-3)


def test_one_start_equals_the_batch():
    _, y, x = chain(300)
    z, rng = np.column_stack([np.ones(300), x]), np.random.default_rng(1)
    mu, sigma, beta = rng.normal(size=(1, 2)), np.array([[1.0, 2.5]]), rng.normal(size=(1, 2, 2))
    one = regime._expect(y, z, mu, sigma, beta)
    two = regime._expect(y, z, *(np.concatenate([v, v]) for v in (mu, sigma, beta)))
    assert all(np.allclose(a[0], b[1]) for a, b in zip(one, two, strict=True))


@pytest.mark.parametrize("bad", [np.ones(300), np.random.default_rng(1).normal(size=100), np.array([np.nan] * 300), np.zeros((300, 2))])
def test_refused_series(bad):
    with pytest.raises(regime.FitError):
        regime.fit(bad)


def test_stationary_share_of_states():
    p = np.array([[.9, .3], [.1, .7]])
    rng, state, seen = np.random.default_rng(0), np.zeros(20_000, int), []
    for _ in range(60):
        state = simulate.draw(p[0, state], rng)
        seen.append(state.mean())
    assert np.mean(seen[30:]) == pytest.approx(0.25, abs=0.01)  # columns are the previous state
    with pytest.raises(ValueError, match="columns"):
        regime.check_transition(p.T)


def test_gbm_quantiles_and_ladder():
    out = simulate.of_gbm(0.05, 1.5, 100.0, simulate.Settings(paths=40_000))
    z = 1.2815515655
    want = [np.exp(.0005 * 5 + k * .015 * np.sqrt(5)) - 1 for k in (-z, 0, z)]
    assert [out["p10"], out["p50"], out["p90"]] == pytest.approx(want, abs=1e-3)
    y = np.random.default_rng(2).normal(size=120)
    got = simulate.forecast("news_markov", y, np.zeros(120), 50.0, simulate.Settings(min_obs=252))
    assert got is None  # too short for every rung
    got = simulate.forecast("news_markov", y, np.zeros(120), 50.0, simulate.Settings(min_obs=100, starts=4))
    assert got["model_used"] in simulate.LADDERS["news_markov"] and got == simulate.forecast("news_markov", y, np.zeros(120), 50.0, simulate.Settings(min_obs=100, starts=4))
    with pytest.raises(ValueError, match="fractions"):
        simulate.of_gbm(0, 150, 100.0, simulate.Settings())


def test_every_arm_refuses_a_short_window():
    y = np.random.default_rng(1).normal(0, 1, 30)
    for arm in ("gbm", "markov", "news_markov"):
        assert simulate.forecast(arm, y, np.zeros(30), 100.0, simulate.Settings(paths=10, starts=2)) is None
        assert simulate.forecast(arm, y, np.zeros(30), 100.0, simulate.Settings(min_obs=20, paths=10, starts=2))["n_obs"] == 30



def test_backtest_sees_nothing_later(spark):
    _, y, x = chain(170)
    days = [d.date() for d in pd.bdate_range("2023-01-02", periods=170)]
    close = 100 * np.exp(np.cumsum(y / 100))
    cfg = simulate.Settings(min_obs=90, paths=200, starts=3)

    def run(c):
        r = np.concatenate([[np.nan], np.diff(np.log(c))])
        rows = [("A", d, float(v), None if np.isnan(k) else float(k), float(z)) for d, v, k, z in zip(days, c, r, x, strict=True)]
        frame = spark.createDataFrame(rows, "ticker string, trade_date date, close double, log_return double, news_sentiment_3d double")
        return {(r["origin_date"], r["model"]): r for r in forecasts.backtest(frame, n_weeks=2, cfg=cfg).collect()}

    first = run(close)
    origin = min(first)[0]
    spoiled = close.copy()
    spoiled[days.index(origin) + 1:] *= np.linspace(1.5, 3, len(days) - days.index(origin) - 1)
    second = run(spoiled)
    for arm in ("news_markov", "markov", "gbm"):
        a, b = first[origin, arm], second[origin, arm]
        assert [a[c] for c in ("p10", "p50", "p90", "prob_positive", "n_obs")] == [b[c] for c in ("p10", "p50", "p90", "prob_positive", "n_obs")]
        assert a["realized_return"] != b["realized_return"]
    assert len(first) == 6


# -- services, tasks, search ------------------------------------------------------------
def test_client():
    waits, pages = [], {"u1": (200, {"request_id": "r1", "results": [{"a": 1}], "next_url": "u2"}), "u2": (200, {"request_id": "r2", "results": [{"a": 2}]})}
    tries = iter([(429, {}), (503, {})])
    now = iter(range(0, 10_000, 1))
    c = client.Client(lambda u: next(tries, None) or pages[u], sleep=waits.append, clock=lambda: next(now))
    assert list(c.pages("u1")) == [{"a": 1, "_request_id": "r1"}, {"a": 2, "_request_id": "r2"}]
    assert any(1 <= w <= 1.25 for w in waits) and any(w > 9 for w in waits)
    quick = {"sleep": lambda s: None, "clock": lambda: 0.0}
    with pytest.raises(client.Refused):
        client.Client(lambda u: (403, {}), **quick).request("u")
    with pytest.raises(client.Unavailable) as e:
        client.Client(lambda u: (500, {}), **quick).request("u?apiKey=SECRET")
    assert "SECRET" not in str(e.value)
    with pytest.raises(client.Unavailable, match="round"):
        list(client.Client(lambda u: (200, {"results": [], "next_url": "u"}), **quick).pages("u"))


def test_paged_source(spark, monkeypatch):
    from tidemark.sources import rest
    spark.dataSource.register(rest.PagedSource)
    reader = rest.PagedReader({"urls": json.dumps(["a", "b", "c"]), "partitions": "2"})
    assert [p.urls for p in reader.partitions()] == [["a", "c"], ["b"]]
    monkeypatch.setattr(rest, "http_get", lambda u: (200, {"request_id": "r", "results": [{"x": 1}]}))
    assert list(reader.read(rest.Share(["a"]))) == [("a", "r", '{"x": 1}')]
    assert spark.read.format("paged_json").option("urls", "[]").load().columns == ["url", "request_id", "row"]


def test_landed_pages_and_config(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"request_id": "r", "results": [{"t": 1, "c": 2.5}, {"t": 2, "c": 3.5}]}))
    assert sorted(map(tuple, tables.landed_pages(spark, str(tmp_path / "p.json"), "t bigint, c double").collect())) == [(1, 2.5, "r"), (2, 3.5, "r")]
    (tmp_path / "c.json").write_text('{"a": {"b": 1}}')
    assert tables.section(tables.config(str(tmp_path / "c.json")), "a") == {"b": 1} and tables.section({}, "x") == {}
    with pytest.raises(LookupError):
        tables.require_table(spark, "no_such_table")


def test_ledger_and_telemetry(spark, tmp_path):
    from tidemark.plans.lease import Lease

    store = Store(spark, f"file://{tmp_path}/tables")
    assert tasks.run_task("build_prices", {"build_prices": lambda s, c: 7}, spark, {}, store) == 7
    with pytest.raises(ZeroDivisionError):
        tasks.run_task("build_news", {"build_news": lambda s, c: 1 // 0}, spark, {}, store)
    rows = {r["task"]: r for r in store.read(TABLES["bronze.ingestion_runs"]).collect()}
    assert rows["build_prices"]["rows_written"] == 7 and rows["build_news"]["status"] == "failed" and "ZeroDivision" in rows["build_news"]["error"]
    log = tasks.Telemetry(store)
    log.record(task="answer", model="m", latency_ms=3.0)
    assert log.flush() == 1 and log.flush() == 0
    small = tasks.Telemetry(store, most=2)
    for k in range(5):
        small.record(task=str(k))
    assert [r["task"] for r in small.rows] == ["3", "4"] and small.dropped == 3
    with Lease(store, "daily").held(), pytest.raises(RuntimeError, match="under way"), Lease(store, "daily").held():
        pass
    with Lease(store, "daily").held():
        pass
    with pytest.raises(OSError):
        tasks.run_task("build_news", {"build_news": lambda s, c: (_ for _ in ()).throw(OSError("u?apiKey=SECRET"))}, spark, {}, store)
    assert not store.read(TABLES["bronze.ingestion_runs"]).where("error like '%SECRET%'").count()
    with pytest.raises(ValueError):
        tasks.write_gold(store, {"gold.backtest_summary": spark.range(1)})


def test_search(spark):
    docs = spark.createDataFrame([(1, "chip demand up"), (2, "chip chip supply"), (3, "weather"), (4, None)], "doc_id long, text string")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "doc_id long, embedding array<double>")
    assert [r["doc_id"] for r in search.bm25(docs, ["chip"]).orderBy(F.desc("score")).collect()] == [2, 1]
    assert [r["doc_id"] for r in search.nearest(vectors, [1.0, 0.1], 10).collect()] == [1, 3, 2]
    assert search.hybrid(docs, vectors, "chip", [1.0, 0.0], k=2).count() == 2 and search.clamp_k(99) == 20


def test_index_gives_the_same_scores(spark, tmp_path):
    from tidemark.plans import serving

    store, recent = Store(spark, f"file://{tmp_path}/tables", buckets=4), TABLES["silver.news_recent"]
    said = lambda rows: spark.createDataFrame([(f"a{i}", "AB"[i % 2], datetime(2026, 8, 1 + i), "t", "p", None, 0, "u", x, f"a{i}:{'AB'[i % 2]}") for i, x in rows], recent.schema)
    plain = lambda t: {r["doc_id"]: round(r["score"], 9) for r in search.bm25(store.read(recent).where(F.col("ticker") == t).select("doc_id", F.col("embedding_text").alias("text")), ["chip", "supply"]).collect()}
    posted = lambda t: {r["doc_id"]: round(r["score"], 9) for r in serving.indexed_scores(store, t, "Chip supply").collect()}
    store.upsert(recent, said([(0, "chip demand"), (1, "chip chip supply"), (2, "weather"), (3, None), (4, "supply of chip")]))
    at = datetime(2026, 8, 11)
    assert serving.sync_index(store, at) == 5 and posted("A") == plain("A") and posted("B") == plain("B") and len(posted("A")) == 2
    store.upsert(recent, said([(0, "nothing left"), (6, "new supply")]))
    store.retain(recent, "published_at", datetime(2026, 8, 3))
    assert serving.sync_index(store, at) > 0 and posted("A") == plain("A") and posted("B") == plain("B") == {}
    assert set(posted("A")) == {"a4:A", "a6:A"} and serving.sync_index(store, at) == 0


def test_model_calls():
    from tidemark.sources.model import Model

    answers = iter([(429, {}), OSError("down apiKey=SECRET"), (200, {"model": "m1", "choices": [{"message": {"role": "assistant", "content": [{"type": "text", "text": "hi"}], "tool_calls": [{"id": "1", "function": {"name": "f", "arguments": '{"a": 1}'}}]}, "finish_reason": "tool_calls"}], "usage": {"prompt_tokens": 3, "completion_tokens": 4}})])

    def post(endpoint, payload):
        assert endpoint == "e1" and payload["messages"] == [{"role": "user", "content": "x"}]
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    waits, rows = [], []
    model = Model({"agent": "e1"}, post, lambda **r: rows.append(r), sleep=waits.append)
    reply = model.call("agent", [{"role": "user", "content": "x"}])
    assert (reply.content, reply.calls[0].parsed(), reply.in_tokens, waits) == ("hi", {"a": 1}, 3, [1.0, 2.0])
    assert rows[0]["ok"] and rows[0]["model"] == "m1" and rows[0]["out_tokens"] == 4
    refused = Model({"agent": "e1"}, lambda e, p: (403, {}), lambda **r: rows.append(r), sleep=waits.append)
    with pytest.raises(client.Refused):
        refused.call("agent", [{"role": "user", "content": "x"}])
    assert rows[-1]["ok"] is False and len(waits) == 2
    with pytest.raises(client.Unavailable):
        Model({"agent": "e1"}, lambda e, p: (200, {}), sleep=waits.append).call("agent", [{"role": "user"}])
    with pytest.raises(client.Unavailable, match="3 attempts"):
        Model({"agent": "e1"}, lambda e, p: (503, {}), sleep=waits.append).call("agent", [{"role": "user"}])
    for bad in ([], [{"content": "x"}]):
        with pytest.raises(ValueError):
            model.call("agent", bad)
    with pytest.raises(KeyError):
        model.call("other", [{"role": "user"}])


def test_filters_answers_and_staged_rows(spark):
    docs = tables.staged(spark, [(1, "A"), (2, "B"), (3, None)], "doc_id long, ticker string", "few_rows")
    assert spark.sql("SELECT count(*) FROM few_rows").first()[0] == 3
    ids = lambda doc: [r[0] for r in docs.where(search.filter_of(doc)).orderBy("doc_id").collect()]
    assert [ids('{"ticker": "A"}'), ids('{"ticker": ["A", "B"], "doc_id": 2}'), ids('{"ticker": null}'), ids("{}"), ids('{"ticker": "A\' OR 1=1"}')] == [[1], [2], [3], [1, 2, 3], []]
    with pytest.raises(ValueError):
        search.filter_of("[1]")
    answer = {"manifest": {"columns": [{"name": "title"}, {"name": "new"}, {"name": "url"}]}, "result": {"data_array": [["t", 1, "u"], ["short"]]}}
    assert search.decoded(answer) == [{"title": "t", "new": 1, "url": "u"}, {"title": "short"}] and search.decoded({}) == []


def test_cache_lifetime():
    now, reads = [0.0], []
    cache = tables.Cache(600, most=2, clock=lambda: now[0])
    read = lambda: reads.append(1) or len(reads)
    assert [cache.get("a", read), cache.get("a", read)] == [1, 1]
    now[0] = 599.0
    assert cache.get("a", read) == 1
    now[0] = 600.0
    assert cache.get("a", read) == 2
    with pytest.raises(ZeroDivisionError):
        cache.get("b", lambda: 1 // 0)
    assert cache.get("b", read) == 3 and cache.get("c", read) == 4 and cache.get("a", read) == 5  # two are held


def test_bounded_reads_and_overrides(spark):
    df = spark.createDataFrame([("A", 2), ("B", 9), ("A", 1)], "ticker string, day int")
    assert tables.pandas_of(df, "ticker", "A", "day")["day"].tolist() == [1, 2]
    with pytest.raises(ValueError, match="more than 1"):
        tables.pandas_of(df, "ticker", "A", "day", most=1)
    conf = {"backtest": {"n_weeks": 26, "paths": 5}}
    assert tables.overridden(conf, "backtest", n_weeks=2, paths=None) == {"backtest": {"n_weeks": 2, "paths": 5}} and conf["backtest"]["n_weeks"] == 26


def test_operational_source_over_jdbc(spark):
    """An in-memory database stands for the operational one; the mark is pushed to it."""
    url, driver = "jdbc:derby:memory:ops;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = spark.createDataFrame([(k, datetime(2026, 1, 1 + k)) for k in range(6)], "id int, changed timestamp")
    rows.write.format("jdbc").options(url=url, dbtable="notes", driver=driver).save()
    fresh = tables.operational(spark, url, "notes", "changed", datetime(2026, 1, 4), driver=driver)
    assert sorted(r[0] for r in fresh.select("id").collect()) == [3, 4, 5]
    assert "PushedFilters: [*" in fresh._jdf.queryExecution().executedPlan().toString()
    assert tables.operational(spark, url, "notes", "changed", driver=driver).count() == 6
    assert tables.point_read(spark, "SELECT id FROM {t} WHERE id = :k", {"t": rows}, k=2) == [{"id": 2}]


def test_display(spark):
    c = lambda x: F.lit(x).cast("double")
    now, at = (F.lit(x).cast("timestamp") for x in ("2026-08-11 12:00:00", "2026-08-10 11:00:00"))
    row = spark.range(1).select(
        numeric.percent(c(0.1234), signed=True), numeric.percent(c(-0.5), 0, True), numeric.percent(c(None)), numeric.number(c(1234567.0)), numeric.number(c(1.25), 1), numeric.fixed(c(0.25349), 4), numeric.fixed(c(float("nan"))),
        timeops.staleness(at, now, 2), timeops.staleness(at, now, 1), timeops.staleness(F.lit(None).cast("timestamp"), now, 1), timeops.news_fetch_start(at, F.lit(date(2026, 1, 1))).cast("string"), timeops.news_fetch_start(F.lit(None).cast("timestamp"), F.lit(date(2026, 1, 1))).cast("string")).first()
    assert tuple(row) == ("+12.3%", "-50%", "—", "1,234,567", "1.2", "0.2535", "—", "Updated 1 day ago", "Updated 1 day ago, more than 1 days: stale", "No data yet", "2026-08-10 11:00:00", "2026-01-01 00:00:00")


# -- registered settings ----------------------------------------------------------------
def test_backtest_and_fits_are_registered_whole(spark, monkeypatch):
    from tidemark.plans import catalog

    seen = {}
    monkeypatch.setattr(catalog, "damped", lambda spark, sf: None)
    monkeypatch.setattr(catalog.fc, "backtest", lambda f, arms=("news_markov", "markov", "gbm"), n_weeks=26, cfg=None: seen.setdefault("backtest", []).append((arms, n_weeks, cfg.paths, cfg.starts)))
    monkeypatch.setattr(catalog.fc, "production", lambda f, arms=("news_markov",), cfg=None: seen.setdefault("production", []).append((arms, cfg.paths, cfg.starts)))
    for q in (catalog.m14, catalog.m11, catalog.m15):
        q(spark, "")
    every = ("news_markov", "markov", "gbm")
    assert seen == {"backtest": [(every, 26, 5_000, 20)], "production": [(every, 5_000, 20), (("news_markov",), 5_000, 20)]}


def test_backtest_windows_are_tasks_of_their_own(spark):
    days = exchange.sessions(date(2025, 1, 2), date(2025, 12, 31))[:60]
    rows = [(t, d, 100.0 + i % 7, 0.01 * (i % 5 - 2) if i else None, 0.0) for t in "AB" for i, d in enumerate(days)]
    f = spark.createDataFrame(rows, "ticker string, trade_date date, close double, log_return double, news_sentiment_3d double")
    out = forecasts.backtest(f, ("gbm",), 5, simulate.Settings(min_obs=20, paths=50))
    assert out.count() == 10 and out.select(F.spark_partition_id()).distinct().count() > 4
    assert [forecasts.parts_for(*x) for x in ((5, 26, 24), (5, 26, 1_000), (10_000, 26, 24), (0, 26, 24))] == [5, 26, 1, 24]

    def bytes_of(weeks):
        made = forecasts.windows(f, weeks, simulate.Settings(min_obs=20), 4).cache()
        return made.count(), made.selectExpr("sum(size(rows))").first()[0], made.selectExpr("sum(size(origins))").first()[0]

    # twice the origins, the same rows and days
    assert [bytes_of(w) for w in (4, 8)] == [(4, 4 * 60, 8), (4, 4 * 60, 16)]
