"""The tables: columns, keys, checks before a write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    name: str
    columns: str
    keys: tuple[str, ...]
    change_feed: bool = False
    bucket_by: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def check(self, df: DataFrame) -> DataFrame:
        """Missing or further columns are errors; types must fit; order is the table's."""
        want = {f.name: f.dataType for f in self.schema}
        missing, more = sorted(want.keys() - set(df.columns)), sorted(set(df.columns) - want.keys())
        if missing or more:
            raise ValueError(f"{self.name}: missing {missing}, not in the table {more}")
        wrong = [c for c, t in want.items() if df.schema[c].dataType != t]
        if wrong:
            raise ValueError(f"{self.name}: types differ in {wrong}")
        return df.select(*want)


_BAR = "open double, high double, low double, close double"
#: Tables with their columns in order and their merge keys (fixed values: the tables' contract).
TABLES = {t.name: t for t in (
    Table("bronze.prices_raw", f"ticker string, source_timestamp timestamp, t_epoch_ms bigint, {_BAR}, vwap double, volume double, transactions bigint, source string, ingested_at timestamp, request_id string", ("ticker", "source_timestamp")),
    Table("bronze.news_raw", "article_id string, ticker string, source_timestamp timestamp, published_utc string, title string, description string, author string, article_url string, image_url string, publisher_name string, publisher_homepage_url string, publisher_logo_url string, publisher_favicon_url string, sentiment string, sentiment_reasoning string, article_tickers array<string>, keywords array<string>, source string, ingested_at timestamp, request_id string", ("article_id", "ticker")),
    Table("bronze.ingestion_runs", "run_id string, task string, started_at timestamp, finished_at timestamp, status string, rows_written bigint, error string", ("run_id",)),
    Table("silver.daily_prices", f"ticker string, trade_date date, {_BAR}, volume bigint, vwap double", ("ticker", "trade_date")),
    Table("silver.news_articles", "article_id string, ticker string, published_at timestamp, title string, description string, publisher string, sentiment_label string, sentiment_score int, sentiment_reasoning string, embedding_text string, article_url string, doc_id string", ("article_id", "ticker"), True),
    Table("silver.news_recent", "article_id string, ticker string, published_at timestamp, title string, publisher string, sentiment_label string, sentiment_score int, article_url string, embedding_text string, doc_id string", ("article_id", "ticker"), True),
    Table("gold.news_terms", "term string, doc_id string, ticker string, tf bigint, n bigint", ("term", "doc_id"), bucket_by=("term",)),
    Table("gold.news_lengths", "doc_id string, ticker string, n bigint", ("doc_id",)),
    Table("gold.index_state", "source string, version bigint, synced_at timestamp", ("source",)),
    Table("silver.daily_features", "ticker string, trade_date date, close double, volume bigint, log_return double, return_5d double, momentum_5d double, realized_vol_20d double, volume_zscore_20d double, s_t double, news_sentiment_3d double, news_count bigint", ("ticker", "trade_date")),
    Table("gold.regime_states", "ticker string, as_of_date date, prob_low_vol double, prob_high_vol double, low_vol_mean double, low_vol_sigma double, high_vol_mean double, high_vol_sigma double, current_news_signal double, model_used string, model_version string", ("ticker", "as_of_date")),
    Table("gold.forecast_runs", "forecast_id string, ticker string, generated_at timestamp, as_of_date date, horizon_days int, model_used string, current_price double, price_p10 double, price_p50 double, price_p90 double, return_p10 double, return_p50 double, return_p90 double, prob_positive double, prob_loss_gt_5pct double, prob_low_vol double, prob_high_vol double, n_paths int, seed bigint, model_version string", ("ticker", "as_of_date", "model_used")),
    Table("gold.backtest_metrics", "origin_date date, ticker string, model string, brier double, mae double, covered_80 boolean, model_used string, converged boolean, failure_reason string, realized_return double, return_p50 double, prob_positive double", ("origin_date", "ticker", "model")),
    Table("gold.backtest_summary", "model string, n bigint, n_tickers int, brier double, mae double, coverage_80 double, fallback_rate double, computed_at timestamp", ("model",)),
    Table("gold.model_calls", "call_id string, ts timestamp, task string, model string, latency_ms double, ok boolean, in_tokens bigint, out_tokens bigint", ("call_id",)),
    Table("gold.lb_watchlist_tickers_history", "watchlist_id string, ticker string, added_at timestamp, added_by string, captured_at timestamp", ("watchlist_id", "ticker")),
    Table("gold.lb_research_reports_history", "report_id string, user_id string, ticker string, question string, report_md string, forecast_id string, created_at timestamp, captured_at timestamp", ("report_id",)),
    Table("app.users", "user_id string, display_name string, created_at timestamp", ("user_id",)),
    Table("app.watchlists", "watchlist_id string, user_id string, name string, created_at timestamp", ("watchlist_id",)),
    Table("app.watchlist_tickers", "watchlist_id string, ticker string, added_at timestamp, added_by string", ("watchlist_id", "ticker")),
    Table("app.research_reports", "report_id string, user_id string, ticker string, question string, report_md string, forecast_id string, created_at timestamp", ("report_id",)),
)}
