"""The test tables in the roles of market, news and operational tables, in Spark and in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exchange, numeric, text, timeops
from tidemark.operators import features, merge
from tidemark.sources.tables import scan

#: The calendar: the whole span in which the test tables may have dates.
FROM, TO = date(1990, 1, 1), date(2010, 12, 31)
MODELS = ("news_markov", "markov", "gbm")
DATES = ", ".join(f"(DATE '{d}')" for d in exchange.sessions(FROM, TO))


def bars(spark: SparkSession, sf: str) -> DataFrame:
    o = scan(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice"])
    return o.select(F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_totalprice").alias("close"), F.col("o_orderkey").alias("seq"))


BARS = "SELECT o_orderpriority AS ticker, o_orderdate AS ts, o_totalprice AS close, o_orderkey AS seq FROM orders"


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """One bar a ticker and session: the latest, by instant and then key."""
    b = bars(spark, sf).select("ticker", timeops.session_date(F.col("ts")).alias("trade_date"), "ts", "close", numeric.volume_to_long(F.col("close")).alias("volume"), "seq")
    return merge.latest_per_key(b, ["ticker", "trade_date"], [F.desc("ts"), F.desc("seq")]).select("ticker", "trade_date", "close", "volume")


NY = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::DATE"
PRICES = f"""SELECT ticker, trade_date, close, volume FROM (
  SELECT ticker, {NY} AS trade_date, close, round(close)::BIGINT AS volume,
         row_number() OVER (PARTITION BY ticker, {NY} ORDER BY ts DESC, seq DESC) AS n FROM ({BARS}) b) WHERE n = 1"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    li = scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag", "l_quantity"])
    o = scan(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    label = F.when(F.col("l_returnflag") == "A", " Positive ").when(F.col("l_returnflag") == "R", "negative").otherwise("mixed")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("article_id"), F.col("o_orderpriority").alias("ticker"), F.col("l_shipdate").cast("timestamp").alias("ts"), label.alias("label"), "l_quantity", "l_partkey")


ARTICLES = """SELECT l_orderkey || '-' || l_linenumber AS article_id, o_orderpriority AS ticker, l_shipdate AS ts,
  CASE l_returnflag WHEN 'A' THEN ' Positive ' WHEN 'R' THEN 'negative' ELSE 'mixed' END AS label, l_quantity, l_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
SCORE = "CASE lower(trim(label)) WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END"


def news(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("ticker", timeops.session_date(F.col("ts")).alias("news_date"), text.sentiment_score(F.col("label")).alias("sentiment_score"))


NEWS = f"SELECT ticker, {NY} AS news_date, {SCORE} AS sentiment_score FROM ({ARTICLES}) a"


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return features.daily_features(prices(spark, sf), news(spark, sf), exchange.sessions_frame(spark, FROM, TO), exchange.next_session(spark, FROM, TO))


def damped(spark: SparkSession, sf: str) -> DataFrame:
    """Features of a price that moves like a share's: order totals vary far too much for the models."""
    return daily(spark, sf).withColumns({"close": 100 * F.pow("close", F.lit(0.02)), "log_return": F.col("log_return") * 0.02})


_W = "PARTITION BY ticker ORDER BY trade_date"
FEATURES = f"""WITH p AS ({PRICES}), s(d) AS (VALUES {DATES}), nn AS ({NEWS}),
m AS (SELECT c::DATE AS calendar_date, min(d) AS session FROM range(DATE '{FROM}', DATE '{TO}' + 1, INTERVAL 1 DAY) r(c) JOIN s ON d >= c::DATE AND d <= c::DATE + 14 GROUP BY 1),
a AS (SELECT ticker, session AS trade_date, avg(coalesce(sentiment_score::DOUBLE, 0.0::DOUBLE)) AS news_sentiment, count(*) AS news_count FROM nn JOIN m ON news_date = calendar_date GROUP BY 1, 2),
j AS (SELECT p.ticker, p.trade_date, close, volume, coalesce(news_sentiment, 0.0::DOUBLE) AS news_sentiment, coalesce(news_count, 0) AS news_count
      FROM p JOIN s ON p.trade_date = d LEFT JOIN a ON a.ticker = p.ticker AND a.trade_date = p.trade_date),
r AS (SELECT *, CASE WHEN close > 0 AND lag(close) OVER ({_W}) > 0 THEN ln(close / lag(close) OVER ({_W})) END AS log_return,
      CASE WHEN close > 0 AND lag(close, 5) OVER ({_W}) > 0 THEN close / lag(close, 5) OVER ({_W}) - 1 END AS return_5d FROM j),
f AS (SELECT *, CASE WHEN count(log_return) OVER w5 = 5 THEN sum(log_return) OVER w5 END AS momentum_5d,
      CASE WHEN count(log_return) OVER w20 = 20 THEN stddev_samp(log_return) OVER w20 END AS realized_vol_20d,
      CASE WHEN count(volume) OVER w20 = 20 THEN (volume - avg(volume::DOUBLE) OVER w20) / nullif(stddev_samp(volume::DOUBLE) OVER w20, 0) END AS volume_zscore_20d,
      (news_sentiment + 0.5::DOUBLE * coalesce(lag(news_sentiment) OVER ({_W}), 0) + 0.25::DOUBLE * coalesce(lag(news_sentiment, 2) OVER ({_W}), 0)) / 1.75::DOUBLE AS news_sentiment_3d
      FROM r WINDOW w5 AS ({_W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), w20 AS ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as forecast rows: three models, quantiles around zero, outcomes from the price."""
    o = scan(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice"])
    used = F.when(F.col("o_custkey") % 5 == 0, "gbm").otherwise(F.col("model"))
    out = o.withColumn("model", F.element_at(F.array(*map(F.lit, MODELS)), (F.col("o_orderkey") % 3 + 1).cast("int")))
    return out.select(F.col("o_orderkey").alias("forecast_id"), F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("date").alias("as_of_date"), "model", used.alias("model_used"), ((F.col("o_custkey") % 100) / 100.0).alias("prob_positive"),
                      (-(F.col("o_custkey") % 7) / 100.0).alias("p10"), ((F.col("o_orderkey") % 5) / 500.0).alias("p50"), ((F.col("o_custkey") % 11) / 100.0).alias("p90"),
                      ((F.col("o_orderkey") % 21 - 10) / 100.0).alias("realized_return"), ((F.col("o_custkey") % 97) / 97.0).alias("prob_high_vol"),
                      F.when(F.col("o_custkey") % 5 == 0, F.concat(F.lit("markov: only "), (F.col("o_custkey") % 9).cast("string"), F.lit(" observations"))).alias("fallback_reason"))


FORECASTS = """SELECT o_orderkey AS forecast_id, o_orderpriority AS ticker, o_orderdate::DATE AS as_of_date, model,
  CASE WHEN o_custkey % 5 = 0 THEN 'gbm' ELSE model END AS model_used, (o_custkey % 100) / 100.0::DOUBLE AS prob_positive,
  -(o_custkey % 7) / 100.0::DOUBLE AS p10, (o_orderkey % 5) / 500.0::DOUBLE AS p50, (o_custkey % 11) / 100.0::DOUBLE AS p90,
  (o_orderkey % 21 - 10) / 100.0::DOUBLE AS realized_return, (o_custkey % 97) / 97.0::DOUBLE AS prob_high_vol,
  CASE WHEN o_custkey % 5 = 0 THEN 'markov: only ' || (o_custkey % 9) || ' observations' END AS fallback_reason
  FROM (SELECT *, (['news_markov', 'markov', 'gbm'])[(o_orderkey % 3 + 1)::INT] AS model FROM orders) o"""


def operational(spark: SparkSession, sf: str) -> DataFrame:
    e = scan(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    return df.select([(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
