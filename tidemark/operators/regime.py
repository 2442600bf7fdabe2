"""Two volatility regimes: Markov-switching normal returns by expectation-maximisation.

y_t = mu[s_t] + sigma[s_t] e_t.  Transition matrices are left-stochastic: P[next, prev],
columns sum to one.  With an exogenous series the probability of regime 0 next, given each
previous regime, is logistic in [1, x_t], where row t governs the step into t.  All random
starts are fitted side by side as one batch; the best by likelihood is kept and polished by quasi-Newton steps.  Everything is
numpy and runs inside grouped tasks, one series a task.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np

SEED, STARTS, MIN_OBS = 20_260_810, 20, 252
#: Steps of all starts, further steps of the best one, and the relative gain at which these end.
FIRST_STEPS, LAST_STEPS, TOLERANCE = 12, 200, 1e-5
#: Quasi-Newton steps after them, halvings of a step, and the slope an observation at which the fit has converged.
POLISH_STEPS, HALVINGS, GRADIENT = 60, 25, 1e-5
#: Bound of the logits' coefficients.
LOGIT = 12.0


class FitError(ValueError):
    """The series can't be fitted by this model."""


@dataclass
class Fit:
    mu: np.ndarray
    sigma: np.ndarray
    beta: np.ndarray  # (prev, [1, x]) logits of P[0, prev]
    filtered: np.ndarray  # (T, 2)
    transition: np.ndarray  # mean over time, (next, prev)
    loglik: float
    converged: bool
    n_obs: int
    tvtp: bool

    def matrix(self, x: float = 0.0) -> np.ndarray:
        """Transition matrix for a value of the exogenous series."""
        p0 = 1 / (1 + np.exp(-np.clip(self.beta @ np.array([1.0, x if self.tvtp else 0.0]), -30, 30)))
        return np.stack([p0, 1 - p0])

    @property
    def current(self) -> np.ndarray:
        p = self.filtered[-1]
        if not np.isclose(p.sum(), 1):
            raise FitError("filtered probabilities don't sum to 1")
        return p


def usable_returns(percent: np.ndarray, min_obs: int) -> np.ndarray:
    y = np.asarray(percent, dtype=float)
    if y.ndim != 1 or not np.isfinite(y).all():
        raise FitError("returns must be one finite series")
    if len(y) < min_obs:
        raise FitError(f"{len(y)} observations, {min_obs} needed")
    if y.std() <= 0:
        raise FitError("returns don't vary")
    return y


def _p0(beta: np.ndarray, z: np.ndarray) -> np.ndarray:
    """(starts, T, prev) probabilities of regime 0 next."""
    return 1 / (1 + np.exp(-np.clip(np.einsum("spk,tk->stp", beta, z), -30, 30)))


def _expect(y, z, mu, sigma, beta):
    """Filtered, smoothed and joint probabilities, likelihoods; a batch over starts."""
    s, n = len(mu), len(y)
    dens = np.exp(-0.5 * ((y[None, :, None] - mu[:, None]) / sigma[:, None]) ** 2) / (sigma[:, None] * np.sqrt(2 * np.pi)) + 1e-300
    p0 = _p0(beta, z)
    stay = p0[:, 0]
    first = stay[:, 1] / np.maximum(1 - stay[:, 0] + stay[:, 1], 1e-12)
    if s == 1:
        kept, smooth, joint, loglik = _expect_one(p0[0], dens[0], float(first[0]))
        return kept[None], smooth[None], joint[None], np.array([loglik]), p0
    # two states are one number a start; a step in time is a handful of operations on rows of the batch
    q0, q1, d0, d1 = (np.ascontiguousarray(v[:, :, k].T) for v in (p0, dens) for k in (0, 1))
    slope, gain = q0 - q1, d0 - d1
    ahead0, kept0, scale, smooth0 = (np.empty((n, s)) for _ in range(4))
    ahead0[0] = first
    for t in range(n):
        a = ahead0[t]
        if t:
            np.multiply(slope[t], kept0[t - 1], out=a)
            a += q1[t]
        c = np.multiply(gain[t], a, out=scale[t])
        c += d1[t]
        f = np.multiply(d0[t], a, out=kept0[t])
        f /= c
    up, down = 1 / np.maximum(ahead0, 1e-300), 1 / np.maximum(1 - ahead0, 1e-300)
    smooth0[-1] = kept0[-1]
    for t in range(n - 1, 0, -1):
        g = smooth0[t]
        v = (1 - g) * down[t]
        w = g * up[t]
        w -= v
        w *= q0[t]
        w += v
        np.multiply(w, kept0[t - 1], out=smooth0[t - 1])
    u, v = smooth0[1:] * up[1:], (1 - smooth0[1:]) * down[1:]
    joint = np.zeros((s, n, 2, 2))
    for i, (q, k) in enumerate(((q0[1:], kept0[:-1]), (q1[1:], 1 - kept0[:-1]))):
        joint[:, 1:, 0, i], joint[:, 1:, 1, i] = (q * k * u).T, ((1 - q) * k * v).T
    both = lambda x: np.stack([x.T, 1 - x.T], axis=2)
    return both(kept0), both(smooth0), joint, np.log(scale).sum(axis=0), p0


def _expect_one(p0: np.ndarray, dens: np.ndarray, first: float):
    """The same recursions for one start, on plain floats: for two states they beat arrays tenfold."""
    q0, q1, d0, d1 = *p0.T.tolist(), *dens.T.tolist()
    n, loglik, ahead0, kept0 = len(q0), 0.0, [first], []
    f0 = 0.0
    for t in range(n):
        if t:
            ahead0.append(q0[t] * f0 + q1[t] * (1 - f0))
        a, b = ahead0[t] * d0[t], (1 - ahead0[t]) * d1[t]
        f0 = a / (a + b)
        kept0.append(f0)
        loglik += log(a + b)
    g, smooth0, joint = kept0[-1], [0.0] * n, [(0.0,) * 4] * n
    for t in range(n - 1, 0, -1):
        smooth0[t] = g
        k, u, v = kept0[t - 1], g / max(ahead0[t], 1e-300), (1 - g) / max(1 - ahead0[t], 1e-300)
        row = (q0[t] * k * u, q1[t] * (1 - k) * u, (1 - q0[t]) * k * v, (1 - q1[t]) * (1 - k) * v)
        joint[t] = row
        g = row[0] + row[2]
    smooth0[0] = g
    both = lambda x: np.column_stack([x, 1 - np.asarray(x)])
    return both(kept0), both(smooth0), np.asarray(joint).reshape(n, 2, 2), loglik


def _maximise(y, z, smooth, joint, beta, floor):
    w = smooth.sum(axis=1) + 1e-12
    mu = (smooth * y[None, :, None]).sum(axis=1) / w
    sigma = np.maximum(np.sqrt((smooth * (y[None, :, None] - mu[:, None]) ** 2).sum(axis=1) / w), floor)
    weight, to0 = joint[:, 1:].sum(axis=2), joint[:, 1:, 0]
    if z.shape[1] == 1 or not z[:, 1].any():
        p = np.clip((to0.sum(axis=1) + 1e-9) / (weight.sum(axis=1) + 2e-9), 1e-6, 1 - 1e-6)
        beta = beta.copy()
        beta[:, :, 0] = np.log(p / (1 - p))
        return mu, sigma, beta
    for _ in range(2):  # Newton steps of a weighted logistic regression, slightly damped
        p = _p0(beta, z[1:])
        grad = np.einsum("stp,tk->spk", to0 - weight * p, z[1:]) - 1e-3 * beta
        curve = np.einsum("stp,tk,tl->spkl", weight * p * (1 - p), z[1:], z[1:]) + np.eye(2) * 1e-2
        beta = np.clip(beta + np.clip(np.linalg.solve(curve, grad[..., None])[..., 0], -1, 1), -LOGIT, LOGIT)
    return mu, sigma, beta


def gradient(y, z, mu, sigma, beta) -> tuple[float, np.ndarray]:
    """Likelihood and its gradient for one start, in (mu, log sigma, beta): the expected score of the complete data
    (Fisher's identity), by the smoothed probabilities of one pass."""
    _, smooth, joint, loglik, p0 = _expect(y, z, mu[None], sigma[None], beta[None])
    w, j, q = smooth[0], joint[0, 1:], p0[0]
    e = (y[:, None] - mu) / sigma
    to_beta = np.einsum("tp,tk->pk", j[:, 0] - j.sum(axis=1) * q[1:], z[1:])
    # the first day's probabilities are stationary, and so depend on beta as well
    off = 1 - q[0, 0] + q[0, 1]
    first = q[0, 1] / off
    slope = np.array([q[0, 1], 1 - q[0, 0]]) / off**2 * q[0] * (1 - q[0])
    to_beta += ((w[0, 0] - first) / (first * (1 - first)) * slope)[:, None] * z[0]
    return float(loglik[0]), np.concatenate([(w * e / sigma).sum(axis=0), (w * (e**2 - 1)).sum(axis=0), to_beta.ravel()])


def polish(y, z, mu, sigma, beta, floor: float, steps: int = POLISH_STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """Quasi-Newton steps (BFGS) from where expectation-maximisation has come to: each must raise the likelihood, so it
    ends no lower than it began.  Returns mu, sigma, beta, the likelihood and the gradient's norm an observation."""
    least, most = np.array([-np.inf] * 2 + [np.log(floor)] * 2 + [-LOGIT] * 4), np.array([np.inf] * 4 + [LOGIT] * 4)

    def parts(t: np.ndarray):
        return t[:2], np.exp(t[2:4]), t[4:].reshape(2, 2)

    def at(t: np.ndarray):
        value, g = gradient(y, z, *parts(t))
        return value, np.where((t <= least) & (g < 0) | (t >= most) & (g > 0), 0.0, g)  # no slope across a bound

    theta = np.clip(np.concatenate([mu, np.log(sigma), beta.ravel()]), least, most)
    value, g = at(theta)
    plain = np.eye(len(theta)) / len(y)
    inverse = plain
    for _ in range(steps):
        if np.abs(g).max() <= GRADIENT * len(y):
            break
        direction = np.where(g == 0, 0.0, inverse @ g)
        if direction @ g <= 0:  # the curvature has gone astray
            inverse = plain
            direction = inverse @ g
        size = min(1.0, 1.0 / max(1e-12, np.abs(direction).max()))
        for _ in range(HALVINGS):
            there = np.clip(theta + size * direction, least, most)
            new_value, new_g = at(there)
            if np.isfinite(new_value) and new_value > value + 1e-4 * ((there - theta) @ g):
                break
            size /= 2
        else:
            if inverse is plain:
                break
            inverse = plain
            continue
        s, d = there - theta, g - new_g
        bounds_met = ((g == 0) != (new_g == 0)).any()
        theta, value, g = there, new_value, new_g
        if bounds_met:
            inverse = plain
        elif s @ d > 1e-12:
            r = 1 / (s @ d)
            left = np.eye(len(theta)) - r * np.outer(s, d)
            inverse = left @ inverse @ left.T + r * np.outer(s, s)
    return *parts(theta), value, float(np.abs(g).max() / len(y))


def fit(percent: np.ndarray, exog: np.ndarray | None = None, min_obs: int = MIN_OBS, starts: int = STARTS, seed: int = SEED) -> Fit:
    """``exog``: the value that governs the step into each observation, as long as the series."""
    y = usable_returns(percent, min_obs)
    x = np.zeros(len(y)) if exog is None else np.asarray(exog, dtype=float)
    if x.shape != y.shape or not np.isfinite(x).all():
        raise FitError("the exogenous series must be finite and as long as the returns")
    z = np.column_stack([np.ones(len(y)), x])
    rng = np.random.default_rng(seed)
    scale = y.std()
    mu = y.mean() + scale * 0.3 * rng.standard_normal((starts, 2))
    sigma = scale * np.exp(0.6 * rng.standard_normal((starts, 2)))
    beta = np.zeros((starts, 2, 2))
    beta[:, 0, 0], beta[:, 1, 0] = rng.uniform(1, 4, starts), -rng.uniform(1, 4, starts)
    floor = 1e-3 * scale
    last, converged = np.full(1, -np.inf), False
    for step in range(FIRST_STEPS + LAST_STEPS):
        kept, smooth, joint, loglik, p0 = _expect(y, z, mu, sigma, beta)
        if step == FIRST_STEPS:  # go on with the best start alone
            best = [int(np.nanargmax(loglik))]
            mu, sigma, beta, kept, smooth, joint, loglik, p0 = (v[best] for v in (mu, sigma, beta, kept, smooth, joint, loglik, p0))
        elif step > FIRST_STEPS and abs(loglik[0] - last[0]) < TOLERANCE * (1 + abs(loglik[0])):
            converged = True
            break
        last = loglik
        mu, sigma, beta = _maximise(y, z, smooth, joint, beta, floor)
    if not np.isfinite(loglik).all():
        raise FitError("the likelihood isn't finite")
    best_mu, best_sigma, best_beta, _, slope = polish(y, z, mu[0], sigma[0], beta[0], floor)
    converged = converged or slope <= GRADIENT
    mu, sigma, beta = best_mu[None], best_sigma[None], best_beta[None]
    kept, _, _, loglik, p0 = _expect(y, z, mu, sigma, beta)
    stay = p0[0].mean(axis=0)
    out = Fit(mu[0], sigma[0], beta[0], kept[0], np.stack([stay, 1 - stay]), float(loglik[0]), converged, len(y), exog is not None and bool(x.any()))
    if is_degenerate(out):
        raise FitError("the regimes are degenerate")
    return by_volatility(out)


def is_degenerate(f: Fit) -> bool:
    diagonal = np.diag(f.transition)
    return bool(abs(f.sigma[1] / f.sigma[0] - 1) < 0.05 or (diagonal > 0.995).any() or (diagonal < 0.005).any())


def by_volatility(f: Fit) -> Fit:
    """Regime 0 is the calmer one; all parts are permuted together (stable)."""
    order = np.argsort(f.sigma, kind="stable")
    if order[0] == 0:
        return f
    return Fit(f.mu[order], f.sigma[order], -f.beta[order], f.filtered[:, order], f.transition[np.ix_(order, order)], f.loglik, f.converged, f.n_obs, f.tvtp)


def check_transition(p: np.ndarray) -> np.ndarray:
    if p.shape != (2, 2) or (p < 0).any() or not np.allclose(p.sum(axis=0), 1):
        raise ValueError("columns of a transition matrix must sum to 1")
    return p
