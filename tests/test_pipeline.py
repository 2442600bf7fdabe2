"""Landed pages through all layers to forecasts, tools and history, over a real store."""

import json
from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest

from tidemark.functions import exchange
from tidemark.operators.simulate import Settings
from tidemark.operators.store import Store
from tidemark.plans import medallion, serving
from tidemark.schema import TABLES

AT = datetime(2026, 8, 11, 6)
ARTICLES = [
    ("a1", {"name": "Wire", "homepage_url": "h"}, "Chips rise", "2026-08-08T12:00:00Z", ["NVDA", "AMD", "MSFT"], [("nvda ", "Positive"), ("MSFT", "positive")]),
    ("a2", "Plain paper", "Memory falls", "2026-08-10T01:00:00Z", ["SNDK"], [("SNDK", "negative")]),
    ("a3", {"name": "Wire"}, "Mixed view", "2026-08-10T15:00:00Z", ["NVDA"], [("NVDA", "mixed")]),
    ("a4", {"name": "Wire"}, "No insight", "2026-08-10T15:00:00Z", ["NVDA"], []),
    (None, {"name": "Wire"}, "No id", "2026-08-10T15:00:00Z", ["NVDA"], [("NVDA", "positive")]),
    ("a6", {"name": "Wire"}, "No time", "soon", ["NVDA"], [("NVDA", "positive")]),
    ("a7", {"name": "Wire"}, "No ticker", "2026-08-10T15:00:00Z", ["NVDA"], [(None, "positive")]),
]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    s = Store(spark, f"file://{tmp_path_factory.mktemp('lake')}", buckets=2)
    rows = [(i, json.dumps(p) if isinstance(p, dict) else p, t, None, at, None, tickers, None, f"About {t}", ["k"], [(a, b, None) for a, b in ins], "r") for i, p, t, at, tickers, ins in ARTICLES]
    pages = spark.createDataFrame(rows, medallion.ARTICLE + ", request_id string")
    assert s.upsert(TABLES["bronze.news_raw"], medallion.raw_news(pages, AT)) == 4
    rng = np.random.default_rng(3)
    days = exchange.sessions(date(2025, 3, 1), date(2026, 8, 10))
    state = (np.arange(len(days)) // 25) % 2
    bars = []
    for ticker in ("NVDA", "MSFT"):
        close = 100 * np.exp(np.cumsum(rng.normal(0, np.where(state, 0.03, 0.008))))
        bars += [(ticker, 1e6, c, c, c, c, c, int(pd.Timestamp(d, tz="America/New_York").timestamp() * 1000), 5, "r") for d, c in zip(days, close.tolist(), strict=True)]
    raw = spark.createDataFrame(bars, f"ticker string, {medallion.BAR}, request_id string")
    s.upsert(TABLES["bronze.prices_raw"], medallion.raw_prices(raw, AT))
    for build in (medallion.build_prices, medallion.build_news, medallion.build_features):
        build(s)
    return s


def test_silver_and_features(spark, store):  # built once more: the same rows
    assert medallion.build_prices(store) == store.read(TABLES["bronze.prices_raw"]).count()
    assert medallion.build_news(store) == 4
    news = {r["doc_id"]: r for r in store.read(TABLES["silver.news_articles"]).collect()}
    assert set(news) == {"a1:NVDA", "a1:MSFT", "a2:SNDK", "a3:NVDA"} and news["a3:NVDA"]["sentiment_score"] == 0
    assert news["a2:SNDK"]["publisher"] == "Plain paper" and news["a1:NVDA"]["sentiment_score"] == 1
    assert [tuple(r) for r in medallion.unknown_labels(store.read(TABLES["bronze.news_raw"])).collect()] == [("mixed", 1)]
    assert medallion.build_features(store) == store.read(TABLES["silver.daily_prices"]).count()
    last = {r["ticker"]: r for r in store.read(TABLES["silver.daily_features"]).where("trade_date = '2026-08-10'").collect()}
    assert (last["MSFT"]["s_t"], last["MSFT"]["news_count"]) == (1.0, 1) and (last["NVDA"]["s_t"], last["NVDA"]["news_count"]) == (0.5, 2)


def test_windows_and_recent(spark, store):
    tickers = spark.createDataFrame([("NVDA",), ("NEW",)], "ticker string")
    got = dict(map(tuple, medallion.fetch_windows(store, "bronze.prices_raw", tickers, date(2026, 1, 1), date(2026, 8, 11)).collect()))
    assert got == {"NVDA": date(2026, 8, 10), "NEW": date(2026, 1, 1)}
    today = date(2026, 8, 11)
    assert medallion.refresh_recent(store, today, 90) == 4 and medallion.refresh_recent(store, today, 90) == 0
    assert medallion.refresh_recent(store, date(2026, 8, 12), 3) == 0
    assert {r[0] for r in store.read(TABLES["silver.news_recent"]).select("article_id").collect()} == {"a2", "a3"}
    start, end = medallion.next_backfill(store, today, 90, 30)
    assert (start, end) == (date(2026, 7, 11), date(2026, 8, 10))
    assert medallion.refresh_recent(store, today, 90, start, end) == 2


def test_forecasts_tools_and_history(spark, store):
    medallion.refresh_recent(store, date(2026, 8, 11), 90)
    cfg = Settings(min_obs=200, paths=300, starts=4)
    assert medallion.fit_models(store, cfg, AT) >= 2
    assert medallion.fit_models(store, cfg, AT) >= 2  # again: the same keys
    runs = store.read(TABLES["gold.forecast_runs"])
    assert runs.count() == 2 and runs.select("forecast_id").distinct().count() == 2
    assert serving.market_page(store).count() == 2
    tools = serving.Tools(store, "u", "w")
    seen = []

    def model(messages, specs):
        seen.append(len(specs))
        if len(seen) == 1:
            return {"role": "assistant", "tool_calls": [{"name": "get_market_forecast", "arguments": '{"ticker": "nvda"}'}, {"name": "search_market_news", "arguments": {"ticker": "NVDA", "query": "chips", "k": 99}}, {"name": "update_watchlist", "arguments": {"action": "add", "ticker": "AMD"}}, {"name": "update_watchlist", "arguments": {"action": "add", "ticker": "NVDA; DROP"}}, {"name": "none"}]}
        return {"role": "assistant", "content": "done"}

    answer = serving.converse("How is NVDA?", tools, model)
    results = [t["result"] for t in answer.trail]
    assert answer.content == "done" and answer.forecast_id == results[0]["forecast_id"]
    assert results[1]["results"][0]["title"] == "Chips rise" and results[2] == {"tickers": ["AMD"]} and "error" in results[3] and "error" in results[4]
    saved = tools.execute("save_research_report", {"ticker": "NVDA", "question": "q", "report_md": "text"})
    assert store.read(TABLES["app.research_reports"]).first()["forecast_id"] == answer.forecast_id and saved["report_id"]
    with pytest.raises(serving.ToolError):
        tools.execute("save_research_report", {"ticker": "NVDA", "question": "q", "report_md": " "})
    assert tools.execute("update_watchlist", {"action": "remove", "ticker": "AMD"}) == {"tickers": []}
    assert serving.converse("x", tools, lambda m, s: {"role": "assistant", "tool_calls": [{"name": "none"}]}).content.startswith("No answer")
    source = store.read(TABLES["app.research_reports"])
    table = "gold.lb_research_reports_history"
    assert medallion.sync_history(store, table, source, "created_at", AT) == 1
    assert medallion.sync_history(store, table, source, "created_at", AT) == 1 and store.read(TABLES[table]).count() == 1  # the boundary row again


def test_backtest_tables(spark, store):
    wrote = medallion.backtest(store, Settings(min_obs=200, paths=100, starts=2), 1, AT)
    assert wrote == 2 * 3 + 3
    assert {r["model"] for r in store.read(TABLES["gold.backtest_summary"]).collect()} == {"news_markov", "markov", "gbm"}


def test_index_drift():
    spec = serving.IndexSpec()
    good = {"source_table": "silver.news_recent", "primary_key": "doc_id", "embedding_column": "embedding_text", "subtype": None, "sync": "TRIGGERED"}
    assert spec.drift(good) == [] and len(spec.drift(good | {"source_table": "silver.news_articles", "subtype": "plain"})) == 2 and len(spec.drift({})) == 3


def bars_page(url, base):
    """What the service says: two pages of bars for NVDA, one for MSFT; one article under both tickers."""
    day = lambda k: int(pd.Timestamp(f"2026-08-{k:02d}", tz="America/New_York").timestamp() * 1000)
    bar = lambda k, c: {"v": 1e6, "vw": c, "o": c, "c": c, "h": c, "l": c, "t": day(k), "n": 5}
    if "/reference/news" in url:
        article = {"id": "a1", "publisher": {"name": "Wire"}, "title": "Chips rise", "published_utc": "2026-08-07T12:00:00Z", "tickers": ["NVDA", "MSFT"], "keywords": [], "insights": [{"ticker": "NVDA", "sentiment": "positive", "sentiment_reasoning": "r"}]}
        return 200, {"request_id": "n", "results": [article]}
    if "page=2" in url:
        return 200, {"request_id": "r2", "results": [bar(7, 12.0)]}
    if "/NVDA/" in url:
        return 200, {"request_id": "r1", "results": [bar(6, 11.0)], "next_url": f"{base}/NVDA/x?page=2"}
    return 200, {"request_id": "r3", "results": [bar(6, 20.0)]}


def test_daily_run_from_the_service(spark, tmp_path, service):
    from tidemark.plans import tasks

    asked = []
    url = service(lambda path: asked.append(path) or bars_page(path, url))
    store = Store(spark, f"file://{tmp_path}/lake", buckets=2)
    conf = {"service": {"base": url, "backfill": "2026-08-01", "per_minute": 1e6}, "tickers": ["nvda", "MSFT", "not a ticker"], "models": {"paths": 50, "starts": 2}, "news_recent": {"days": 90, "step": 30}}
    jobs = medallion.daily_tasks(store, AT)
    assert set(jobs) == {n for n, _, _ in tasks.DAILY}
    wrote = tasks.run_daily(jobs, spark, conf, store, with_optional=True)
    assert (wrote["ingest_prices"], wrote["ingest_news"], wrote["build_prices"], wrote["build_news"], wrote["refresh_news_recent"], wrote["sync_news_index"]) == (3, 1, 3, 1, 1, 1)
    assert sorted(asked) == ["/NVDA/x?page=2", *(f"/v2/aggs/ticker/{t}/range/1/day/2026-08-01/2026-08-11?adjusted=true&sort=asc&limit=50000" for t in ("MSFT", "NVDA")),
                             *(f"/v2/reference/news?ticker={t}&published_utc.gte=2026-08-01T00:00:00Z&order=asc&sort=published_utc&limit=1000" for t in ("MSFT", "NVDA"))]
    assert wrote["build_features"] == 3 and wrote["fit_models"] == 0  # far too few sessions for a model
    assert tasks.run_task("ingest_prices", jobs, spark, conf, store) == 3 and store.read(TABLES["bronze.prices_raw"]).count() == 3  # the same bars again
    assert tasks.run_task("sync_news_index", jobs, spark, conf, store) == 0
    runs = store.read(TABLES["bronze.ingestion_runs"]).groupBy("status").count().collect()
    assert [tuple(r) for r in runs] == [("succeeded", len(tasks.DAILY) + 2)]


def test_failures_of_a_daily_run(spark, tmp_path, monkeypatch):
    from tidemark.plans import tasks

    class Ledgerless(Store):
        def upsert(self, table, source):
            return 0

    with_lock, done = Ledgerless(spark, f"file://{tmp_path}"), []
    jobs = {n: (lambda _, conf, n=n: done.append(n) or 1) for n, _, _ in tasks.DAILY}
    monkeypatch.setattr(spark, "createDataFrame", lambda *a: None)
    with pytest.raises(ZeroDivisionError):
        tasks.run_daily(jobs | {"build_news": lambda *_: 1 // 0}, spark, {}, with_lock)
    assert done == ["ingest_prices", "ingest_news", "build_prices"]
    out = tasks.run_daily(jobs | {"backfill_news_recent": lambda *_: 1 // 0}, spark, {}, with_lock, with_optional=True)
    assert set(out) == {n for n, _, optional in tasks.DAILY if not optional}  # the lock is free again; what is optional may fail
