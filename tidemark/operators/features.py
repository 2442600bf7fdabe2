"""Window functions of the daily features, and the other per-ticker windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import numeric as num

#: Weights of today's and the two sessions' news before (fixed values).
NEWS_WEIGHTS = (1.0, 0.5, 0.25)


def by_session(key: str = "ticker", day: str = "trade_date"):
    return Window.partitionBy(key).orderBy(day)


def full(count_of: Column, rows: int, value: Column) -> Column:
    """``value`` over a frame only if all its rows count."""
    return F.when(count_of == rows, value)


def with_returns(bars: DataFrame) -> DataFrame:
    w = by_session()
    return bars.withColumns({"log_return": num.log_return(F.col("close"), F.lag("close", 1).over(w)), "return_5d": num.simple_return(F.col("close"), F.lag("close", 5).over(w))})


def news_decay(s: Column, w) -> Column:
    zero = F.lit(0.0)
    total = sum(F.lit(k) * F.coalesce(s if i == 0 else F.lag(s, i).over(w), zero) for i, k in enumerate(NEWS_WEIGHTS))
    return total / F.lit(sum(NEWS_WEIGHTS))


def daily_features(bars: DataFrame, news: DataFrame, sessions: DataFrame, next_session: DataFrame) -> DataFrame:
    """One row per ticker and session.

    bars: ticker, trade_date, close, volume.  news: ticker, news_date, sentiment_score.
    sessions (trade_date) and next_session (calendar_date, trade_date) are calendars of some
    hundred rows a year and are broadcast.  News of a day without a session counts for the
    next session; what lies past the last one isn't attached.
    """
    held = bars.join(F.broadcast(sessions), "trade_date", "left_semi")
    per_session = news.join(F.broadcast(next_session), news["news_date"] == next_session["calendar_date"]).groupBy("ticker", "trade_date").agg(F.avg(F.coalesce(F.col("sentiment_score").cast("double"), F.lit(0.0))).alias("news_sentiment"), F.count("*").alias("news_count"))
    joined = held.join(per_session, ["ticker", "trade_date"], "left").withColumns({"news_sentiment": F.coalesce("news_sentiment", F.lit(0.0)), "news_count": F.coalesce("news_count", F.lit(0))})
    w = by_session()
    w5, w20 = w.rowsBetween(-4, 0), w.rowsBetween(-19, 0)
    r, v = F.col("log_return"), F.col("volume").cast("double")
    return with_returns(joined).withColumns({
        "momentum_5d": full(F.count(r).over(w5), 5, F.sum(r).over(w5)),
        "realized_vol_20d": full(F.count(r).over(w20), 20, F.stddev_samp(r).over(w20)),
        "volume_zscore_20d": full(F.count(v).over(w20), 20, F.try_divide(v - F.avg(v).over(w20), F.stddev_samp(v).over(w20))),
        "news_sentiment_3d": news_decay(F.col("news_sentiment"), w),
    }).select("ticker", "trade_date", "close", "volume", "log_return", "return_5d", "momentum_5d", "realized_vol_20d", "volume_zscore_20d", "news_count", "news_sentiment", "news_sentiment_3d")


def indexed(df: DataFrame) -> DataFrame:
    """idx: number of the session within its ticker, from 0."""
    return df.withColumn("idx", F.row_number().over(by_session()) - 1)


def usable_so_far(r: Column) -> Column:
    return F.count(r).over(by_session().rowsBetween(Window.unboundedPreceding, 0))


def outcome(close: Column, horizon: int) -> Column:
    return F.lead(close, horizon).over(by_session()) / close - 1


def warmup_offset(df: DataFrame) -> DataFrame:
    """Per ticker: first session with a return, and how many after it lack one."""
    at = indexed(df)
    first = F.min(F.when(F.col("log_return").isNotNull(), F.col("idx"))).over(Window.partitionBy("ticker"))
    return at.withColumn("first", first).groupBy("ticker").agg(F.max("first").alias("warmup"), F.sum(F.when(F.col("log_return").isNull() & (F.col("idx") > F.col("first")), 1).otherwise(0)).alias("gaps"))


def out_of_order(df: DataFrame, seq: str) -> DataFrame:
    """Rows whose date isn't after that of the row before, in the order of ``seq``."""
    w = Window.partitionBy("ticker").orderBy(seq)
    return df.where(F.col("trade_date").isNotNull()).withColumn("before", F.lag("trade_date").over(w)).where(F.col("trade_date") <= F.col("before"))


def weekly_origins(features: DataFrame, n_weeks: int, min_train: int, horizon: int) -> DataFrame:
    """Of each ticker's last ``n_weeks`` ISO weeks, the last session that has enough training rows and an outcome."""
    at = indexed(features).withColumns({"usable": usable_so_far(F.col("log_return")), "realized_return": outcome(F.col("close"), horizon)}).where((F.col("usable") >= min_train) & F.col("realized_return").isNotNull())
    at = at.withColumns({"iso_year": F.extract(F.lit("YEAROFWEEK"), "trade_date"), "iso_week": F.extract(F.lit("WEEK"), "trade_date")})
    last = Window.partitionBy("ticker", "iso_year", "iso_week").orderBy(F.desc("trade_date"))
    weeks = Window.partitionBy("ticker").orderBy(F.desc("iso_year"), F.desc("iso_week"))
    return at.withColumn("k", F.row_number().over(last)).where("k = 1").withColumn("week", F.row_number().over(weeks)).where(F.col("week") <= n_weeks).select("ticker", F.col("trade_date").alias("origin_date"), F.col("idx").alias("origin_idx"), "realized_return", "close")
