"""Sequential and simulated parts: lots with holding locks, a monthly backtest, stationary bootstrap paths."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession


@dataclass
class Book:
    """Holdings as lots. ``per_lot`` locks each lot for ``days`` after its purchase, otherwise the last purchase locks all."""

    days: int = 30
    per_lot: bool = True
    lots: dict[str, list[tuple[int, float]]] = field(default_factory=dict)

    def units(self, name: str) -> float:
        return sum(u for _, u in self.lots.get(name, []))

    def free(self, name: str, day: int) -> float:
        """Units that may be sold on a day."""
        held = self.lots.get(name, [])
        if not self.per_lot:
            return 0.0 if held and day - max(d for d, _ in held) < self.days else self.units(name)
        return sum(u for d, u in held if day - d >= self.days)

    def buy(self, name: str, units: float, day: int) -> None:
        if units > 0:
            self.lots.setdefault(name, []).append((day, units))

    def sell(self, name: str, units: float, day: int) -> float:
        """Sells up to the free units, oldest lots first; returns what was sold."""
        left = done = min(units, self.free(name, day))
        rest = []
        for bought, held in sorted(self.lots.get(name, [])):
            part = min(held, left) if day - bought >= self.days or not self.per_lot else 0.0
            left -= part
            if held - part > 1e-12:
                rest.append((bought, held - part))
        self.lots[name] = rest
        return done


def trade_cost(value: np.ndarray, half_spread: np.ndarray, sigma: np.ndarray, adv: np.ndarray, impact: float = 0.60) -> np.ndarray:
    """Half the spread and a square-root impact."""
    return value * (half_spread + impact * sigma * np.sqrt(value / adv))


def backtest(returns: np.ndarray, targets: dict[int, np.ndarray], cash: float, half_spread: float = 0.0005, lock_days: int = 0) -> dict[str, np.ndarray | float]:
    """Holds targets decided at the close of a row from the next row on; weights sum to 1 at most, the rest is cash.

    ``returns`` is rows x names; ``targets`` maps a row to weights. Sales go first and are limited by locks, purchases by
    cash. Rows follow each other, so this runs in one place, one task per configuration.
    """
    n = returns.shape[1]
    price = np.vstack([np.ones(n), np.cumprod(1 + np.nan_to_num(returns), axis=0)])
    book, wealth, paid, traded = Book(lock_days), [cash], 0.0, 0.0
    names = [str(i) for i in range(n)]
    for t in range(len(returns)):
        if t in targets:
            now = price[t]
            held = np.array([book.units(x) for x in names])
            total = cash + held @ now
            wanted = targets[t] * total / now
            for i in np.flatnonzero(wanted < held):
                sold = book.sell(names[i], held[i] - wanted[i], t) * now[i]
                cash += sold * (1 - half_spread)
                paid, traded = paid + sold * half_spread, traded + sold
            for i in np.flatnonzero(wanted > held):
                spend = min((wanted[i] - held[i]) * now[i], cash / (1 + half_spread))
                book.buy(names[i], spend / now[i], t)
                cash -= spend * (1 + half_spread)
                paid, traded = paid + spend * half_spread, traded + spend
        wealth.append(cash + sum(book.units(x) * price[t + 1][i] for i, x in enumerate(names)))
    path = np.array(wealth)
    return {"wealth": path, "cost": paid, "traded": traded, "drawdown": float((path / np.maximum.accumulate(path) - 1).min())}


def bootstrap_paths(spark: SparkSession, returns: np.ndarray, weights: np.ndarray, paths: int, length: int, block: float, seed: int = 0) -> DataFrame:
    """Stationary bootstrap of a fixed mix: (path, final, drawdown). Blocks have a geometric length with mean ``block``.

    Each path has a generator of its own, so results do not depend on how paths are dealt to tasks.
    """
    shared = spark.sparkContext.broadcast((returns, weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        history, mix = shared.value
        earned = history @ mix
        for batch in batches:
            out = []
            for path in batch["id"]:
                rng = np.random.default_rng([seed, int(path)])
                fresh = rng.random(length) < 1 / block
                fresh[0] = True
                starts = rng.integers(len(earned), size=length)
                last = np.maximum.accumulate(np.where(fresh, np.arange(length), 0))
                rows = (starts[last] + np.arange(length) - last) % len(earned)
                level = np.cumprod(1 + earned[rows])
                out.append((int(path), float(level[-1]), float((level / np.maximum.accumulate(np.maximum(level, 1.0)) - 1).min())))
            yield pd.DataFrame(out, columns=["path", "final", "drawdown"])

    return spark.range(paths).mapInPandas(run, "path long, final double, drawdown double")
