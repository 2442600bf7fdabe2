"""Return distributions by simulation, and the ladder of models."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.operators import regime

#: From the richest model down; a model that can't be fitted hands over to the next (fixed order).
LADDERS = {"news_markov": ("news_markov", "markov", "gbm"), "markov": ("markov", "gbm"), "gbm": ("gbm",)}
HALF_LIFE = 2.0


@dataclass(frozen=True)
class Settings:
    horizon: int = 5
    paths: int = 5_000
    seed: int = 42
    half_life: float = HALF_LIFE
    min_obs: int = regime.MIN_OBS
    starts: int = regime.STARTS


def gbm(percent: np.ndarray, min_obs: int) -> tuple[float, float]:
    """Mean and sample deviation of percent returns."""
    y = regime.usable_returns(percent, max(min_obs, 2))
    sigma = y.std(ddof=1)
    if sigma <= 0:
        raise regime.FitError("returns don't vary")
    return float(y.mean()), float(sigma)


def check_scale(price: float, sigmas: np.ndarray) -> None:
    if not (np.isfinite(price) and price > 0):
        raise ValueError("the price must be positive")
    if (np.asarray(sigmas) >= 1).any():
        raise ValueError("deviations must be decimal fractions")


def draw(p_of_zero: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """States, 0 with the given probabilities."""
    return (rng.random(len(p_of_zero)) >= p_of_zero).astype(np.intp)


def summarise(terminal: np.ndarray, price: float) -> dict[str, float]:
    r = terminal / price - 1
    low, mid, high = np.percentile(r, [10, 50, 90])
    return {"p10": float(low), "p50": float(mid), "p90": float(high), "prob_positive": float((r > 0).mean()), "prob_drop_5pct": float((r < -0.05).mean())}


def of_gbm(mu: float, sigma: float, price: float, cfg: Settings) -> dict[str, float]:
    """mu and sigma in percent; estimation is in percent, results are fractions."""
    check_scale(price, np.array([sigma / 100]))
    steps = mu / 100 + sigma / 100 * np.random.default_rng(cfg.seed).standard_normal((cfg.horizon, cfg.paths))
    return summarise(price * np.exp(steps.sum(axis=0)), price)


def of_regimes(f: regime.Fit, price: float, news: float, cfg: Settings) -> dict[str, float]:
    check_scale(price, f.sigma / 100)
    rng = np.random.default_rng(cfg.seed)
    state = draw(np.full(cfg.paths, f.current[0]), rng)
    logs = np.zeros(cfg.paths)
    for h in range(1, cfg.horizon + 1):
        # news fades with its half-life from the first day on; without news the matrix is the same every day
        p = regime.check_transition(f.matrix(news * np.exp(-np.log(2) / cfg.half_life * h)))
        state = draw(p[0, state], rng)
        logs += f.mu[state] / 100 + f.sigma[state] / 100 * rng.standard_normal(cfg.paths)
    return summarise(price * np.exp(logs), price)


def forecast(arm: str, percent: np.ndarray, news: np.ndarray, price: float, cfg: Settings) -> dict | None:
    """The first model of the arm's ladder that can be fitted; None if none can.

    percent: returns of the window.  news: one value a return, on the same days."""
    reasons: list[str] = []
    for model in LADDERS[arm]:
        try:
            if model == "gbm":
                mu, sigma = gbm(percent, cfg.min_obs)
                out = of_gbm(mu, sigma, price, cfg) | {"converged": None, "prob_low_vol": None, "prob_high_vol": None, "sigma_low": None, "sigma_high": None, "mu_low": None, "mu_high": None}
            else:
                exog = None
                if model == "news_markov":  # yesterday's news governs today's step; the first day has none
                    exog, own = np.asarray(news, float)[:-1], np.asarray(percent, float)[1:]
                else:
                    own = percent
                f = regime.fit(own, exog, cfg.min_obs, cfg.starts)
                out = of_regimes(f, price, float(news[-1]) if exog is not None else 0.0, cfg)
                out |= {"converged": f.converged, "prob_low_vol": float(f.current[0]), "prob_high_vol": float(f.current[1]), "sigma_low": float(f.sigma[0] / 100), "sigma_high": float(f.sigma[1] / 100), "mu_low": float(f.mu[0] / 100), "mu_high": float(f.mu[1] / 100)}
            return out | {"model": arm, "model_used": model, "fallback_reason": "; ".join(reasons) or None, "n_obs": len(percent)}
        except regime.FitError as e:
            reasons.append(f"{model}: {e}")
    return None
