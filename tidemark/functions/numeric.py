"""Numbers: returns, scores, bands, display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


def volume_to_long(c: Column) -> Column:
    """Half up."""
    return F.round(c, 0).cast("long")


def log_return(close: Column, before: Column) -> Column:
    """Null unless both prices are positive."""
    return F.when((close > 0) & (before > 0), F.ln(close / before))


def simple_return(close: Column, before: Column) -> Column:
    return F.when((close > 0) & (before > 0), close / before - F.lit(1.0))


def decayed(news: Column, h: Column, half_life: float) -> Column:
    return news * F.exp(-F.ln(F.lit(2.0)) / F.lit(float(half_life)) * h)


def brier(p: Column, outcome: Column) -> Column:
    return F.pow(p - F.when(outcome > 0, 1.0).otherwise(0.0), F.lit(2.0))


def covered(outcome: Column, low: Column, high: Column) -> Column:
    """Inclusive at both ends."""
    return (outcome >= low) & (outcome <= high)


def noise_band(n: Column) -> Column:
    return F.sqrt(F.lit(0.25 * 0.75) / n)


def verdict(ours: Column, theirs: Column, n: Column) -> Column:
    """A smaller Brier score is better, if by more than the noise."""
    return F.when(F.abs(ours - theirs) <= noise_band(n), "indistinguishable").when(ours < theirs, "better").otherwise("worse")


def direction(p: Column) -> Column:
    """At most .45 down, at least .55 up."""
    return F.when(p.isNull(), DASH).when(p >= 0.55, "up").when(p > 0.45, "flat").otherwise("down")


def regime_badge(low: Column, high: Column) -> Column:
    return F.when(high >= low, "turbulent").otherwise("calm")


def band_offset(value: Column, low: Column, high: Column) -> Column:
    """Place inside a band in percent, clamped."""
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.coalesce(F.try_divide(value - low, high - low), F.lit(0.5)) * 100))


def known(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c), F.lit(None)).otherwise(c)


def percent(c: Column, digits: int = 1, signed: bool = False) -> Column:
    """Of a fraction; ``signed`` puts a plus before what isn't negative."""
    said = F.format_string(f"%{'+' if signed else ''}.{digits}f%%", known(c).cast("double") * 100)
    return F.when(known(c).isNull(), DASH).otherwise(said)


def number(c: Column, digits: int = 0) -> Column:
    """With separated thousands."""
    return F.coalesce(F.format_number(known(c.cast("double")), digits), F.lit(DASH))


def fixed(c: Column, digits: int = 2) -> Column:
    """A bare decimal of so many places."""
    return F.when(known(c.cast("double")).isNull(), DASH).otherwise(F.format_string(f"%.{digits}f", c.cast("double")))


def money(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(known(c), 2)), F.lit(DASH))


def degenerate(sigma0: Column, sigma1: Column, stay0: Column, stay1: Column) -> Column:
    """Regimes that can't be told apart, or that never (or always) change."""
    stuck = lambda p: (p > 0.995) | (p < 0.005)
    return (F.abs(sigma1 / sigma0 - 1) < 0.05) | stuck(stay0) | stuck(stay1)


def coverage_band(c: Column, target: float = 0.80, width: float = 0.05) -> Column:
    return F.when(F.abs(c - target) <= width, "on target").when(c < target, "too narrow").otherwise("too wide")


def fallback_band(c: Column) -> Column:
    return F.when(c < 0.5, "mostly itself").when(c <= 0.65, "often falls back").when(c < 1, "mostly falls back").otherwise("always falls back")
