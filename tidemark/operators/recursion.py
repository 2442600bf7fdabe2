"""Two-regime recursions as native folds: the filter of a series, and transition matrices that follow the news.

Parameters are columns, so every series may have its own: a struct mu0, mu1, sigma0, sigma1 (percent) and a0, b0, a1, b1, where the
probability of regime 0 next, given regime i now, is 1 / (1 + exp(-(a_i + b_i x))).  A series is an array
of (y, x) in order of time, x being what governs the step into y; the fold carries one number from step to step.
A series must fit a row, as daily data of a century does; series are rows and need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Added to densities, so that no observation is impossible (fixed value).
LEAST_DENSITY = 1e-300
PARAMETERS = ("mu0", "mu1", "sigma0", "sigma1", "a0", "b0", "a1", "b1")


def parameters(**values: float) -> Column:
    """The same parameters for all series."""
    return F.struct(*[F.lit(float(values[k])).alias(k) for k in PARAMETERS])


def to_calm(p: Column, given: int, x: Column) -> Column:
    """Probability of regime 0 next, given a regime now."""
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), p[f"a{given}"] + p[f"b{given}"] * x))))


def _density(p: Column, regime: int, y: Column) -> Column:
    d = (y - p[f"mu{regime}"]) / p[f"sigma{regime}"]
    return F.exp(-0.5 * d * d) / (p[f"sigma{regime}"] * F.sqrt(2 * F.pi())) + LEAST_DENSITY


def _step(p: Column, state: Column, row: Column) -> tuple[Column, Column]:
    """Filtered probability of regime 0 and the observation's likelihood; a state without probability starts stationary."""
    q0, q1 = to_calm(p, 0, row["x"]), to_calm(p, 1, row["x"])
    ahead = F.coalesce(q0 * state["calm"] + q1 * (1 - state["calm"]), q1 / F.greatest(1 - q0 + q1, F.lit(1e-12)))
    a, b = ahead * _density(p, 0, row["y"]), (1 - ahead) * _density(p, 1, row["y"])
    return a / (a + b), a + b


def filtered_last(p: Column, series: Column) -> Column:
    """calm: probability of regime 0 at the last observation by all up to it; loglik.  calm is null for an empty series."""
    start = F.struct(F.lit(None).cast("double").alias("calm"), F.lit(0.0).alias("loglik"))

    def step(state: Column, row: Column) -> Column:
        calm, likelihood = _step(p, state, row)
        return F.struct(calm.alias("calm"), (state["loglik"] + F.log(likelihood)).alias("loglik"))

    return F.aggregate(series, start, step)


def filtered_path(p: Column, series: Column) -> Column:
    """The probability of regime 0 after each observation.  Each step copies the path so far: for series of some thousand."""
    start = F.struct(F.lit(None).cast("double").alias("calm"), F.array().cast("array<double>").alias("path"))

    def step(state: Column, row: Column) -> Column:
        calm, _ = _step(p, state, row)
        return F.struct(calm.alias("calm"), F.concat(state["path"], F.array(calm)).alias("path"))

    return F.aggregate(series, start, step, lambda state: state["path"])


def matrices(p: Column, news: Column, days: int, half_life: float) -> Column:
    """For each coming day the left-stochastic matrix (day, p00, p10, p01, p11: next, now), as the news fades."""
    def of(day: Column) -> Column:
        x = news * F.exp(-F.log(F.lit(2.0)) / half_life * day)
        q0, q1 = to_calm(p, 0, x), to_calm(p, 1, x)
        return F.struct(day.cast("int").alias("day"), q0.alias("p00"), (1 - q0).alias("p10"), q1.alias("p01"), (1 - q1).alias("p11"))

    return F.transform(F.sequence(F.lit(1), F.lit(days)), of)


def checked(m: Column) -> Column:
    """The matrix, or an error: its entries are probabilities and its columns sum to one."""
    inside = lambda c: (c >= 0) & (c <= 1)
    good = inside(m["p00"]) & inside(m["p10"]) & inside(m["p01"]) & inside(m["p11"]) & (F.abs(m["p00"] + m["p10"] - 1) < 1e-9) & (F.abs(m["p01"] + m["p11"] - 1) < 1e-9)
    return F.when(F.coalesce(good, F.lit(False)), m).otherwise(F.raise_error(F.lit("columns of a transition matrix must sum to 1")))


def series_of(rows: DataFrame, key: str, order: str, y: str, x: str, *latest: str) -> DataFrame:
    """key, days, series (array of y, x) in order, and the last row's ``latest`` columns; rows without y don't count."""
    held = F.array_sort(F.collect_list(F.struct(F.col(order).alias("day"), F.col(y).alias("y"), F.col(x).alias("x"))))
    found = rows.where(F.col(y).isNotNull()).groupBy(key).agg(held.alias("rows"), *[F.max_by(c, order).alias(c) for c in latest])
    return found.select(key, F.col("rows.day").alias("days"), F.transform("rows", lambda r: F.struct(r["y"].alias("y"), r["x"].alias("x"))).alias("series"), *latest)
