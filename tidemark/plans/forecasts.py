"""Forecasts of all tickers, walk-forward backtests and their scores, as distributed plans."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import numeric as num
from tidemark.operators import simulate
from tidemark.operators.features import indexed, weekly_origins

#: Tasks of a backtest for each core, so that slow fits even out; a task a part of a ticker up to so many.
TASKS_PER_CORE, MOST_TASKS = 8, 50_000
_OUT = ("model string, model_used string, fallback_reason string, n_obs long, p10 double, p50 double, p90 double, prob_positive double, prob_drop_5pct double, "
        "prob_low_vol double, prob_high_vol double, sigma_low double, sigma_high double, mu_low double, mu_high double, converged boolean")
FORECAST = f"ticker string, as_of_date date, current_price double, {_OUT}"
SCORED = f"ticker string, origin_date date, realized_return double, {_OUT}"
_COLUMNS = [x.split()[0] for x in _OUT.split(", ")]


def _window(returns: np.ndarray, news: np.ndarray, close: np.ndarray, arms: tuple[str, ...], cfg: simulate.Settings) -> list[dict]:
    """Forecasts of one window whose last row is the day they are made; rows without return don't count."""
    usable = ~np.isnan(returns)
    found = (simulate.forecast(arm, returns[usable] * 100, news[usable], float(close[-1]), cfg) for arm in arms)
    return [f for f in found if f is not None]


def _numbers(values: Iterable) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in values], dtype=float)


def _frame(rows: list[dict], schema: str) -> pd.DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]
    return pd.DataFrame(rows, columns=names)


def production(features: DataFrame, arms: tuple[str, ...] = ("news_markov",), cfg: simulate.Settings | None = None) -> DataFrame:
    """One fit a ticker and arm at its last session, each ticker a task of its own."""
    cfg = cfg or simulate.Settings()

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("trade_date")
        rows = _window(*(pdf[c].to_numpy(dtype=float) for c in ("log_return", "news_sentiment_3d", "close")), arms, cfg)
        return _frame([r | {"ticker": key[0], "as_of_date": pdf["trade_date"].iloc[-1], "current_price": float(pdf["close"].iloc[-1])} for r in rows], FORECAST)

    return features.select("ticker", "trade_date", "close", "log_return", "news_sentiment_3d").groupBy("ticker").applyInPandas(run, FORECAST)


def parts_for(tickers: int, origins: int, tasks: int) -> int:
    """Parts of a ticker's origins: as many as give every task some, one where there are tickers enough."""
    return max(1, min(origins, -(-tasks // max(1, tickers))))


def windows(features: DataFrame, n_weeks: int, cfg: simulate.Settings, tasks: int) -> DataFrame:
    """ticker, rows (its days in order), origins (some of its origins): a row for each part of a ticker's origins.

    A ticker's days are one sorted array, and a window is the beginning of it, so what is shuffled doesn't depend on the
    number of origins: a history goes once to its own row, and once to each of ``parts_for`` tasks."""
    kept = indexed(features.select("ticker", "trade_date", "close", "log_return", "news_sentiment_3d"))
    rows = F.array_sort(F.collect_list(F.struct("idx", "close", "log_return", "news_sentiment_3d"))).alias("rows")
    histories = kept.groupBy("ticker").agg(rows)
    origins = weekly_origins(features, n_weeks, cfg.min_obs, cfg.horizon)
    parts = parts_for(features.select("ticker").distinct().count(), n_weeks, tasks)
    number = F.row_number().over(Window.partitionBy("ticker").orderBy("origin_date")) % parts
    dealt = origins.withColumn("part", number).groupBy("ticker", "part").agg(F.collect_list(F.struct("origin_date", "origin_idx", "realized_return")).alias("origins"))
    return histories.join(dealt, "ticker").select("ticker", "rows", "origins")


def backtest(features: DataFrame, arms: tuple[str, ...] = ("news_markov", "markov", "gbm"), n_weeks: int = 26, cfg: simulate.Settings | None = None) -> DataFrame:
    """Scores of every arm at every origin.  A window holds the rows up to its origin and no later one, and is shared by the arms."""
    cfg = cfg or simulate.Settings()
    tasks = TASKS_PER_CORE * features.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ticker, rows, origins in zip(pdf["ticker"], pdf["rows"], pdf["origins"], strict=True):
                returns, news, close = (_numbers(r[c] for r in rows) for c in ("log_return", "news_sentiment_3d", "close"))
                for o in origins:
                    upto = o["origin_idx"] + 1  # days are numbered from 0 without gaps
                    told = {"ticker": ticker, "origin_date": o["origin_date"], "realized_return": o["realized_return"]}
                    yield _frame([r | told for r in _window(returns[:upto], news[:upto], close[:upto], arms, cfg)], SCORED)

    made = windows(features, n_weeks, cfg, tasks)
    # round robin: neither few keys nor few bytes bring windows together in one task
    n = made.count()
    return scored(made.repartition(max(1, min(n, MOST_TASKS))).mapInPandas(run, SCORED))


def scored(made: DataFrame) -> DataFrame:
    """An outcome that isn't finite is an error."""
    r = F.col("realized_return")
    r = F.when(r.isNull() | F.isnan(r) | (F.abs(r) == float("inf")), F.raise_error(F.lit("an outcome isn't finite")).cast("double")).otherwise(r)
    return made.withColumns({"brier": num.brier(F.col("prob_positive"), r), "abs_error": F.abs(F.col("p50") - r), "covered_80": num.covered(r, F.col("p10"), F.col("p90"))})


def pooled(scores: DataFrame) -> DataFrame:
    """Per model: n, tickers, mean scores, coverage, share of fallbacks."""
    return scores.groupBy("model").agg(
        F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers"), F.avg("brier").alias("brier"), F.avg("abs_error").alias("mae"),
        F.avg(F.col("covered_80").cast("double")).alias("coverage"), F.avg((F.col("model_used") != F.col("model")).cast("double")).alias("fallback_rate"))


def fallback_breakdown(scores: DataFrame, top: int = 5) -> tuple[DataFrame, DataFrame]:
    """(model -> model_used counts, the most frequent reasons by their first 80 characters)."""
    used = scores.groupBy("model", "model_used").agg(F.count("*").alias("n"))
    reasons = scores.where("fallback_reason is not null").groupBy(F.substring("fallback_reason", 1, 80).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(top)
    return used, reasons
