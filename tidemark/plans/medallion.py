"""From landed pages to gold tables: each layer as a DataFrame, each task as an upsert.

One grouped watermark, one union and one upsert serve all tickers of a task; nothing loops
over tickers on the driver.
"""

from __future__ import annotations

import json
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exchange, text, timeops
from tidemark.functions.numeric import volume_to_long
from tidemark.operators import features, merge, simulate
from tidemark.operators.store import Store
from tidemark.plans import forecasts
from tidemark.schema import TABLES
from tidemark.sources.tables import working_folder

#: Fields of the service's rows (fixed values: its contract).
BAR = "v double, vw double, o double, c double, h double, l double, t bigint, n bigint"
ARTICLE = ("id string, publisher string, title string, author string, published_utc string, article_url string, tickers array<string>, image_url string, "
           "description string, keywords array<string>, insights array<struct<ticker:string,sentiment:string,sentiment_reasoning:string>>")
SOURCE, VERSION = "vendor", "1"
#: Routes of the service (fixed values: its contract).
PRICES_URL = "{base}/v2/aggs/ticker/{ticker}/range/1/day/{start}/{end}?adjusted=true&sort=asc&limit=50000"
NEWS_URL = "{base}/v2/reference/news?ticker={ticker}&published_utc.gte={start}&order=asc&sort=published_utc&limit=1000"
FORECASTS_NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


# -- bronze -----------------------------------------------------------------------------
def raw_prices(pages: DataFrame, at: datetime) -> DataFrame:
    """pages: ticker, request_id and the fields of BAR."""
    return pages.where("ticker is not null and t is not null").select(
        F.upper(F.trim("ticker")).alias("ticker"), timeops.instant_of_millis(F.col("t")).alias("source_timestamp"), F.col("t").alias("t_epoch_ms"), F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("c").alias("close"),
        F.col("vw").alias("vwap"), F.col("v").alias("volume"), F.col("n").alias("transactions"), F.lit(SOURCE).alias("source"), F.lit(at).cast("timestamp").alias("ingested_at"), "request_id")


def raw_news(pages: DataFrame, at: datetime) -> DataFrame:
    """One row for each article and insight; articles without insight, id or time give none, nor do
    insights without ticker.  ``publisher`` is a JSON object or a plain name."""
    rows = pages.where("id is not null").withColumn("i", F.explode("insights"))
    part = lambda k: F.get_json_object("publisher", f"$.{k}")
    out = rows.select(
        F.col("id").alias("article_id"), F.upper(F.trim("i.ticker")).alias("ticker"), timeops.parsed_instant(F.col("published_utc")).alias("source_timestamp"), "published_utc", "title", "description", "author", "article_url", "image_url",
        text.publisher_name(F.col("publisher")).alias("publisher_name"), part("homepage_url").alias("publisher_homepage_url"), part("logo_url").alias("publisher_logo_url"), part("favicon_url").alias("publisher_favicon_url"),
        F.col("i.sentiment").alias("sentiment"), F.col("i.sentiment_reasoning").alias("sentiment_reasoning"), text.strings(F.col("tickers")).alias("article_tickers"), text.strings(F.col("keywords")).alias("keywords"),
        F.lit(SOURCE).alias("source"), F.lit(at).cast("timestamp").alias("ingested_at"), "request_id")
    return out.where("source_timestamp is not null and ticker is not null and ticker <> ''")


def fetch_windows(store: Store, table: str, tickers: DataFrame, backfill: date, today: date) -> DataFrame:
    """ticker, fetch_from of all tickers, by one aggregate."""
    held = store.read(TABLES[table]).groupBy("ticker").agg(F.max(timeops.session_date(F.col("source_timestamp"))).alias("held"))
    return tickers.join(held, "ticker", "left").select("ticker", timeops.price_fetch_start(F.col("held"), F.lit(backfill), F.lit(today)).alias("fetch_from"))


def news_windows(store: Store, tickers: DataFrame, backfill: date) -> DataFrame:
    """ticker, fetch_from (an instant, inclusive) of all tickers, by one aggregate."""
    held = store.read(TABLES["bronze.news_raw"]).groupBy("ticker").agg(F.max("source_timestamp").alias("held"))
    return tickers.join(held, "ticker", "left").select("ticker", timeops.news_fetch_start(F.col("held"), F.lit(backfill)).alias("fetch_from"))


def _fetched(store: Store, wanted: DataFrame, url: Column, schema: str, options: dict[str, str]) -> DataFrame:
    """Rows of all pages that ``wanted`` (ticker, and what ``url`` is made of) asks for: the fields of ``schema``, ticker,
    request_id.  The tasks ask the service, ``partitions`` of them sharing its budget; what they bring lands before it is
    used, so that nothing is asked twice."""
    from tidemark.sources.rest import fetched

    shares = max(1, int(options.get("partitions", 1)))
    asked = wanted.where("ticker is not null").select("ticker", url.alias("url")).repartition(shares)
    landed = working_folder(store.spark, "pages")
    fetched(asked, float(options.get("per_minute", 5)) / shares, options.get("key_env")).write.parquet(landed)
    return store.spark.read.parquet(landed).select(F.from_json("row", schema).alias("r"), "ticker", "request_id")


def ingest_prices(store: Store, tickers: DataFrame, base: str, backfill: date, today: date, at: datetime, **options: str) -> int:
    """Daily bars of all tickers from their last session on, upserted."""
    store.create(TABLES["bronze.prices_raw"])
    wanted = fetch_windows(store, "bronze.prices_raw", tickers, backfill, today)
    url = F.format_string(PRICES_URL.format(base=base.replace("%", "%%"), ticker="%s", start="%s", end=today), _quoted(F.col("ticker")), F.date_format("fetch_from", "yyyy-MM-dd"))
    rows = _fetched(store, wanted, url, BAR, options).select("r.*", "ticker", "request_id")
    return store.upsert(TABLES["bronze.prices_raw"], merge.latest_per_key(raw_prices(rows, at), ["ticker", "source_timestamp"], [F.desc("request_id")]))


def ingest_news(store: Store, tickers: DataFrame, base: str, backfill: date, at: datetime, **options: str) -> int:
    """Articles of all tickers from the newest instant held on, upserted; an article found for two tickers is one."""
    store.create(TABLES["bronze.news_raw"])
    wanted = news_windows(store, tickers, backfill)
    url = F.format_string(NEWS_URL.format(base=base.replace("%", "%%"), ticker="%s", start="%s"), _quoted(F.col("ticker")), F.date_format("fetch_from", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    rows = _fetched(store, wanted, url, ARTICLE, options).select("r.*", "request_id")
    return store.upsert(TABLES["bronze.news_raw"], merge.latest_per_key(raw_news(rows, at), ["article_id", "ticker"], [F.desc("request_id")]))


def _quoted(ticker: Column) -> Column:
    return F.replace(F.url_encode(ticker), F.lit("+"), F.lit("%20"))


# -- silver -----------------------------------------------------------------------------
def daily_prices(bronze: DataFrame) -> DataFrame:
    day = bronze.withColumn("trade_date", timeops.session_date(F.col("source_timestamp")))
    latest = merge.latest_per_key(day, ["ticker", "trade_date"], [F.desc("source_timestamp"), F.desc("ingested_at"), F.desc_nulls_last("request_id")])
    return latest.select("ticker", "trade_date", "open", "high", "low", "close", volume_to_long(F.col("volume")).alias("volume"), "vwap")


def news_articles(bronze: DataFrame) -> DataFrame:
    latest = merge.latest_per_key(bronze, ["article_id", "ticker"], [F.desc("ingested_at"), F.desc("source_timestamp"), F.desc_nulls_last("request_id"), F.desc_nulls_last("sentiment")])
    label = F.nullif(text.normal_label(F.col("sentiment")), F.lit(""))
    return latest.select(
        "article_id", "ticker", timeops.parsed_instant(F.col("published_utc"), F.col("source_timestamp")).alias("published_at"), "title", "description", F.col("publisher_name").alias("publisher"), label.alias("sentiment_label"),
        text.sentiment_score(F.col("sentiment")).alias("sentiment_score"), "sentiment_reasoning", text.embedding_text(F.col("title"), F.col("description")).alias("embedding_text"), "article_url", text.document_id(F.col("article_id"), F.col("ticker")).alias("doc_id"))


def unknown_labels(bronze: DataFrame) -> DataFrame:
    label = text.normal_label(F.col("sentiment"))
    return bronze.groupBy(label.alias("label")).agg(F.count("*").alias("n")).where(F.col("label").isNotNull() & ~F.col("label").isin(list(text.SENTIMENT)))


def build_prices(store: Store) -> int:
    return store.upsert(TABLES["silver.daily_prices"], daily_prices(store.read(TABLES["bronze.prices_raw"])))


def build_news(store: Store) -> int:
    return store.upsert(TABLES["silver.news_articles"], news_articles(store.read(TABLES["bronze.news_raw"])))


def refresh_recent(store: Store, today: date, days: int = 90, start: date | None = None, end: date | None = None) -> int:
    """Rolling window: changed rows first, then what fell out is trimmed, so that readers never see a
    hole.  With start and end it fills that older slice instead."""
    recent = TABLES["silver.news_recent"]
    store.create(recent)
    floor = F.lit(today) - F.expr(f"interval {int(days)} days")
    begin = F.lit(start) if start else floor
    source = store.read(TABLES["silver.news_articles"]).where(F.col("published_at") >= begin.cast("timestamp"))
    if end:
        source = source.where(F.col("published_at") < F.lit(end).cast("timestamp"))
    columns = recent.schema.fieldNames()
    written = store.upsert(recent, merge.changed(source.select(columns), store.read(recent), columns))
    edge = store.spark.range(1).select(floor.cast("timestamp")).first()[0]
    if store.read(recent).where(F.col("published_at") < F.lit(edge)).head(1):
        store.retain(recent, "published_at", edge)
    return written


def next_backfill(store: Store, today: date, days: int, step: int) -> tuple[date, date] | None:
    """The next older slice of the window [start, end), or None when the window is full."""
    oldest = store.read(TABLES["silver.news_recent"]).agg(F.min("published_at").cast("date")).first()[0] or today
    a, b = timeops.backfill_slice(F.lit(oldest), timeops.retention_floor(F.lit(today), days), step)
    start, end = store.spark.range(1).select(a, b).first()
    return (start, end) if start < end else None


def build_features(store: Store) -> int:
    prices, news = store.read(TABLES["silver.daily_prices"]), store.read(TABLES["silver.news_articles"])
    first, last = prices.agg(F.min("trade_date"), F.max("trade_date")).first()
    if first is None:
        return 0
    dated = news.select("ticker", timeops.session_date(F.col("published_at")).alias("news_date"), "sentiment_score")
    made = features.daily_features(prices, dated, exchange.sessions_frame(store.spark, first, last), exchange.next_session(store.spark, first, last))
    return store.upsert(TABLES["silver.daily_features"], made.withColumnRenamed("news_sentiment", "s_t"))


# -- gold -------------------------------------------------------------------------------
def forecast_rows(made: DataFrame, cfg: simulate.Settings, at: datetime) -> DataFrame:
    """forecast_runs from production forecasts: the id follows from ticker, date and model."""
    price = lambda c: F.col("current_price") * (1 + F.col(c))
    name = F.concat_ws("|", "ticker", "as_of_date", "model_used")
    return made.select(
        text.surrogate_id(FORECASTS_NAMESPACE, name).alias("forecast_id"), "ticker", F.lit(at).cast("timestamp").alias("generated_at"), "as_of_date", F.lit(cfg.horizon).alias("horizon_days"), "model_used", "current_price",
        *[price(c).alias(f"price_{c}") for c in ("p10", "p50", "p90")], *[F.col(c).alias(f"return_{c}") for c in ("p10", "p50", "p90")], "prob_positive", F.col("prob_drop_5pct").alias("prob_loss_gt_5pct"), "prob_low_vol", "prob_high_vol",
        F.lit(cfg.paths).alias("n_paths"), F.lit(cfg.seed).cast("long").alias("seed"), F.lit(VERSION).alias("model_version"))


def regime_rows(made: DataFrame, featured: DataFrame) -> DataFrame:
    """regime_states; a day of the plain model has no regimes and gives no row."""
    signal = featured.select("ticker", F.col("trade_date").alias("as_of_date"), F.col("news_sentiment_3d").alias("current_news_signal"))
    return made.where("model_used <> 'gbm'").join(signal, ["ticker", "as_of_date"], "left").select(
        "ticker", "as_of_date", "prob_low_vol", "prob_high_vol", F.col("mu_low").alias("low_vol_mean"), F.col("sigma_low").alias("low_vol_sigma"), F.col("mu_high").alias("high_vol_mean"), F.col("sigma_high").alias("high_vol_sigma"), "current_news_signal", "model_used", F.lit(VERSION).alias("model_version"))


def fit_models(store: Store, cfg: simulate.Settings, at: datetime) -> int:
    """Forecasts are made once, written aside by the upsert's staging, and shaped twice."""
    from tidemark.plans.tasks import write_gold

    featured = store.read(TABLES["silver.daily_features"])
    made = forecasts.production(featured, ("news_markov",), cfg).persist()
    try:
        return write_gold(store, {"gold.forecast_runs": forecast_rows(made, cfg, at), "gold.regime_states": regime_rows(made, featured)})
    finally:
        made.unpersist()


def backtest(store: Store, cfg: simulate.Settings, n_weeks: int, at: datetime) -> int:
    from tidemark.plans.tasks import write_gold

    scores = forecasts.backtest(store.read(TABLES["silver.daily_features"]), n_weeks=n_weeks, cfg=cfg).persist()
    try:
        metrics = scores.select("origin_date", "ticker", "model", "brier", F.col("abs_error").alias("mae"), "covered_80", "model_used", "converged", F.col("fallback_reason").alias("failure_reason"), "realized_return", F.col("p50").alias("return_p50"), "prob_positive")
        summary = forecasts.pooled(scores).select("model", "n", F.col("tickers").cast("int").alias("n_tickers"), "brier", "mae", F.col("coverage").alias("coverage_80"), "fallback_rate", F.lit(at).cast("timestamp").alias("computed_at"))
        return write_gold(store, {"gold.backtest_metrics": metrics, "gold.backtest_summary": summary})
    finally:
        scores.unpersist()


def sync_history(store: Store, table: str, source: DataFrame, column: str, at: datetime) -> int:
    """Rows at or after the target's high-water mark, stamped and upserted; deletes aren't followed."""
    target = TABLES[table]
    store.create(target)
    mark = store.read(target).agg(F.max(column)).first()[0]
    fresh = merge.since(source, column, None if mark is None else F.lit(mark))
    return store.upsert(target, fresh.withColumn("captured_at", F.lit(at).cast("timestamp")).select(target.schema.fieldNames()))


def universe(store: Store, seed: list[str]) -> DataFrame:
    """ticker: the configured ones and those of all watchlists."""
    table = TABLES["app.watchlist_tickers"]
    store.create(table)
    given = store.spark.createDataFrame([(t,) for t in seed], "ticker string")
    return given.unionByName(store.read(table).select("ticker")).select(text.normal_ticker(F.col("ticker")).alias("ticker")).where("ticker is not null").distinct()


def daily_tasks(store: Store, now: datetime | None = None) -> dict:
    """What each of the daily tasks does; the configuration has the sections ``service`` (base, key_env, per_minute,
    backfill), ``models`` (settings of the forecasts), ``news_recent`` (days, step) and the list ``tickers``."""
    from tidemark.plans import serving

    at = now or datetime.now(UTC)
    today = at.date()
    part = lambda conf, name: conf.get(name) or {}
    options = lambda conf: {k: str(v) for k, v in part(conf, "service").items() if k in ("key_env", "per_minute", "partitions")}
    since = lambda conf: date.fromisoformat(str(part(conf, "service").get("backfill", today - timedelta(days=730))))
    window = lambda conf: (int(part(conf, "news_recent").get("days", 90)), int(part(conf, "news_recent").get("step", 30)))

    def backfilled(_, conf: dict) -> int:
        days, step = window(conf)
        piece = next_backfill(store, today, days, step)
        return refresh_recent(store, today, days, *piece) if piece else 0

    def histories(*_) -> int:
        pairs = (("app.watchlist_tickers", "gold.lb_watchlist_tickers_history", "added_at"), ("app.research_reports", "gold.lb_research_reports_history", "created_at"))
        for source, *_rest in pairs:
            store.create(TABLES[source])
        return sum(sync_history(store, target, store.read(TABLES[source]), column, at) for source, target, column in pairs)

    return {
        "ingest_prices": lambda _, conf: ingest_prices(store, universe(store, conf.get("tickers") or []), conf["service"]["base"], since(conf), today, at, **options(conf)),
        "ingest_news": lambda _, conf: ingest_news(store, universe(store, conf.get("tickers") or []), conf["service"]["base"], since(conf), at, **options(conf)),
        "build_prices": lambda *_: build_prices(store),
        "build_news": lambda *_: build_news(store),
        "build_features": lambda *_: build_features(store),
        "refresh_news_recent": lambda _, conf: refresh_recent(store, today, window(conf)[0]),
        "fit_models": lambda _, conf: fit_models(store, simulate.Settings(**part(conf, "models")), at),
        "sync_news_index": lambda *_: serving.sync_index(store, at),
        "sync_history": histories,
        "backfill_news_recent": backfilled,
    }
