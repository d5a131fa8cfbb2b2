"""Long-only weights by projected gradients, holding rules, and frontiers. Small matrices on one machine."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .risk import inverse_volatility, simplex


def descend(gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray, step: float, rounds: int = 2000, tolerance: float = 1e-10) -> np.ndarray:
    """Accelerated projected gradient descent over long-only, fully invested weights."""
    w = ahead = simplex(start)
    momentum = 1.0
    for _ in range(rounds):
        new = simplex(ahead - step * gradient(ahead))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - w)
        if np.abs(new - w).max() < tolerance:
            return new
        w, momentum = new, following
    return w


def _equal(n: int) -> np.ndarray:
    return np.full(n, 1 / n)


def mean_variance(mean: np.ndarray, cov: np.ndarray, aversion: float = 5.0, benchmark: np.ndarray | None = None) -> np.ndarray:
    """Most of mean less half the aversion times variance (of the difference to a benchmark if one is given)."""
    base = np.zeros(len(mean)) if benchmark is None else benchmark
    top = np.linalg.eigvalsh(cov)[-1]
    return descend(lambda w: aversion * cov @ (w - base) - mean, _equal(len(mean)), 1 / (aversion * top))


def minimum_variance(cov: np.ndarray) -> np.ndarray:
    return mean_variance(np.zeros(len(cov)), cov, 1.0)


def equal_risk(cov: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Weights whose parts of the variance are equal: cyclical coordinate descent on the log-barrier form."""
    n = len(cov)
    w = inverse_volatility(cov)
    for _ in range(rounds):
        before = w.copy()
        for i in range(n):
            rest = cov[i] @ w - cov[i, i] * w[i]
            w[i] = (-rest + np.sqrt(rest**2 + 4 * cov[i, i] / n)) / (2 * cov[i, i])
        if np.abs(w - before).max() < 1e-12:
            break
    return w / w.sum()


def most_diversified(cov: np.ndarray) -> np.ndarray:
    """The largest ratio of weighted volatilities to the portfolio's: least variance of standardized names, rescaled."""
    sd = np.sqrt(np.diag(cov))
    raw = minimum_variance(cov / np.outer(sd, sd)) / sd
    return raw / raw.sum()


def within_tracking_error(mean: np.ndarray, cov: np.ndarray, benchmark: np.ndarray, budget: float) -> np.ndarray:
    """The most mean at a tracking error of at most ``budget``: the aversion is searched on a log scale."""
    low, high = 1e-3, 1e6
    for _ in range(40):
        middle = np.sqrt(low * high)
        active = mean_variance(mean, cov, middle, benchmark) - benchmark
        low, high = (middle, high) if np.sqrt(active @ cov @ active) > budget else (low, middle)
    return mean_variance(mean, cov, high, benchmark)


def frontier(mean: np.ndarray, cov: np.ndarray, points: int = 10) -> list[tuple[float, float, np.ndarray]]:
    """(volatility, mean, weights) from the least variance to the most mean."""
    found = [mean_variance(mean, cov, a) for a in np.geomspace(1e4, 0.05, points)]
    return [(float(np.sqrt(w @ cov @ w)), float(w @ mean), w) for w in found]


def resampled(mean: np.ndarray, cov: np.ndarray, rows: int, draws: int, aversion: float = 5.0, seed: int = 0) -> np.ndarray:
    """The mean of weights over simulated histories, so small differences of means weigh less."""
    rng = np.random.default_rng(seed)
    total = np.zeros(len(mean))
    for _ in range(draws):
        x = rng.multivariate_normal(mean, cov, rows)
        total += mean_variance(x.mean(axis=0), np.cov(x, rowvar=False), aversion)
    return total / draws


def held(returns: np.ndarray, weights: np.ndarray, rule: str = "yearly", band: float = 0.05, year: int = 12) -> np.ndarray:
    """Wealth of a mix under a holding rule: ``yearly`` and ``drift`` (outside the band) go back to the weights, ``never`` does not."""
    if rule not in ("yearly", "never", "drift"):
        raise ValueError(f"unknown rule {rule!r}")
    parts, wealth = weights.astype(float).copy(), [1.0]
    for t, r in enumerate(returns, 1):
        parts = parts * (1 + r)
        total = parts.sum()
        if (rule == "yearly" and t % year == 0) or (rule == "drift" and np.abs(parts / total - weights).max() > band):
            parts = total * weights
        wealth.append(total)
    return np.array(wealth)
