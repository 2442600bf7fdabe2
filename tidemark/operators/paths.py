"""Simulated paths as rows, with random numbers that are functions of their place.

The number of (seed, path, day, use) is made of the first 52 bits of the SHA-256 digest of these four, so it is the same on every
executor, in every order and after every retry, and in any other engine; two forecasts share their numbers
(common random numbers), and more paths leave the first ones as they are.  Normal numbers come by Box and Muller.

The numbers, a row a path, are made once and broadcast (PATHS rows at most); a forecast is a row of parameters,
a path a fold over its days, and the summary an aggregate with exact quantiles of a forecast's paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most paths: what is broadcast is a row of some numbers each.
PATHS = 100_000
DIGITS = 13


def uniform(seed: int, path: Column, day: Column, use: str) -> Column:
    """A number in (0, 1)."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), path.cast("string"), day.cast("string"), F.lit(use)), 256)
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") + 0.5) / F.lit(float(16**DIGITS))


def normal(seed: int, path: Column, day: Column) -> Column:
    return F.sqrt(-2 * F.log(uniform(seed, path, day, "r"))) * F.cos(2 * F.pi() * uniform(seed, path, day, "a"))


def numbers(spark: SparkSession, seed: int, paths: int, days: int) -> DataFrame:
    """path, first (uniform, for the regime on the day itself), steps (u, z) of the days 1 to ``days``."""
    if not 0 < paths <= PATHS:
        raise ValueError(f"1 to {PATHS} paths")
    p = F.col("path")
    steps = F.transform(F.sequence(F.lit(1), F.lit(days)), lambda d: F.struct(d.alias("day"), uniform(seed, p, d, "u").alias("u"), normal(seed, p, d).alias("z")))
    return spark.range(paths).withColumnRenamed("id", "path").select("path", uniform(seed, p, F.lit(0), "u").alias("first"), steps.alias("steps"))


def _spread(forecasts: DataFrame, drawn: DataFrame, paths: int) -> DataFrame:
    """A row for each forecast and path."""
    return forecasts.withColumn("path", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(paths - 1).cast("long")))).join(F.broadcast(drawn), "path")


def _guarded(price: Column, *sigmas: Column) -> Column:
    """The price, or an error: it is positive and finite, and deviations in percent stay below 100."""
    good = (price > 0) & (price < float("inf"))
    for s in sigmas:
        good = good & (s / 100 < 1)
    return F.when(F.coalesce(good, F.lit(False)), price).otherwise(F.raise_error(F.lit("a price must be positive and deviations percent")).cast("double"))


def summarised(ends: DataFrame, key: str) -> DataFrame:
    """Quantiles and probabilities of each forecast's returns; ends: key, r."""
    q = F.percentile("r", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    found = ends.groupBy(key).agg(q.alias("q"), F.avg((F.col("r") > 0).cast("double")).alias("prob_positive"), F.avg((F.col("r") < -0.05).cast("double")).alias("prob_drop_5pct"))
    return found.select(key, *[F.col("q")[i].alias(n) for i, n in enumerate(("p10", "p50", "p90"))], "prob_positive", "prob_drop_5pct")


def of_gbm(forecasts: DataFrame, key: str, seed: int = 42, paths: int = 5_000, days: int = 5) -> DataFrame:
    """forecasts: key, price, mu, sigma (percent a day)."""
    drawn = numbers(forecasts.sparkSession, seed, paths, days)
    logs = F.aggregate("steps", F.lit(0.0), lambda s, d: s + F.col("mu") / 100 + F.col("sigma") / 100 * d["z"])
    price = _guarded(F.col("price"), F.col("sigma"))
    return summarised(_spread(forecasts, drawn, paths).select(key, (price * F.exp(logs) / price - 1).alias("r")), key)


def of_regimes(forecasts: DataFrame, key: str, seed: int = 42, paths: int = 5_000, days: int = 5) -> DataFrame:
    """forecasts: key, price, p (mu0, mu1, sigma0, sigma1 in percent), calm (probability of regime 0 now), days (matrices of
    ``days`` coming days).  A day's regime is drawn by the day's matrix, its return by the regime."""
    drawn = numbers(forecasts.sparkSession, seed, paths, days)
    p = F.col("p")
    start = F.struct((F.col("first") >= F.col("calm")).alias("wild"), F.lit(0.0).alias("log"))

    def step(state: Column, day: Column) -> Column:
        u, z = day["s"]["u"], day["s"]["z"]
        wild = u >= F.when(state["wild"], day["m"]["p01"]).otherwise(day["m"]["p00"])
        return F.struct(wild.alias("wild"), (state["log"] + F.when(wild, p["mu1"]).otherwise(p["mu0"]) / 100 + F.when(wild, p["sigma1"]).otherwise(p["sigma0"]) / 100 * z).alias("log"))

    both = F.zip_with("days", "steps", lambda m, s: F.struct(m.alias("m"), s.alias("s")))
    logs = F.aggregate(both, start, step, lambda state: state["log"])
    price = _guarded(F.col("price"), p["sigma0"], p["sigma1"])
    return summarised(_spread(forecasts, drawn, paths).select(key, (price * F.exp(logs) / price - 1).alias("r")), key)
