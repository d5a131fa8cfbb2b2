"""Cross-sections and time-series fits: standardizing, weighted regressions per session, ridge, eigenportfolios, Newey-West."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Robust standard deviations at which values are winsorized, and the factor from a median deviation to a standard one.
ROBUST, MAD_TO_SD = 5.0, 1.4826


def standard_params(df: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """What standardizes each group of ``by``: winsor bounds lo and hi (null without a spread), weighted mean mu, deviation sd, n.

    Three small aggregates; no group is collected. Missing values count for nothing.
    """
    known = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"), F.col(weight).alias("_w"))
    middle = known.groupBy(*by).agg(F.median("_v").alias("_med"), F.count("_v").alias("n"))
    spread = known.join(middle, by).groupBy(*by).agg((MAD_TO_SD * F.median(F.abs(F.col("_v") - F.col("_med")))).alias("_mad"))
    reach = F.when(F.col("_mad") > 0, ROBUST * F.col("_mad"))
    limits = middle.join(spread, by).select(*by, "n", (F.col("_med") - reach).alias("lo"), (F.col("_med") + reach).alias("hi"))
    rows = known.join(limits, by).withColumn("_x", F.least(F.greatest("_v", "lo"), F.col("hi")))
    mean = F.coalesce(F.try_divide(F.sum(F.col("_x") * F.col("_w")), F.sum("_w")), F.avg("_x"))
    return rows.groupBy(*by).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"), mean.alias("mu"), F.stddev_pop("_x").alias("sd"), F.first("n").alias("n"))


def standardize_with(df: DataFrame, params: DataFrame, by: list[str], value: str, name: str, clip: float = 3.0, how: str = "left") -> DataFrame:
    """Adds the z-score of ``value`` under parameters of its group, which other rows may have given.

    Missing values get 0, as do groups with fewer than 3 values or no spread. ``how`` is left, or inner to leave out rows
    of groups without parameters.
    """
    own = params.select(*by, *[F.col(c).alias(f"_{c}") for c in ("lo", "hi", "mu", "sd", "n")])
    z = (F.least(F.greatest(F.col(value), F.col("_lo")), F.col("_hi")) - F.col("_mu")) / F.col("_sd")
    usable = F.col(value).isNotNull() & (F.col("_n") >= 3) & (F.col("_sd") > 0)
    scored = df.join(own, by, how).withColumn(name, F.when(usable, F.least(F.greatest(z, F.lit(-clip)), F.lit(clip))).otherwise(0.0))
    return scored.select(*df.columns, name)


def standardized(df: DataFrame, by: list[str], value: str, weight: str, name: str, clip: float = 3.0) -> DataFrame:
    """Adds a z-score within each group of ``by``: winsorized, centred on the weighted mean, over the population deviation."""
    return standardize_with(df, standard_params(df, by, value, weight), by, value, name, clip)


def weighted_slope(x: Column, y: Column, w: Column) -> tuple[Column, Column]:
    """(intercept, slope) of a weighted regression on one variable, as aggregates."""
    sw, sx, sy = F.sum(w), F.sum(w * x), F.sum(w * y)
    slope = F.try_divide(sw * F.sum(w * x * y) - sx * sy, sw * F.sum(w * x * x) - sx * sx)
    return (sy - slope * sx) / sw, slope


def cross_section(df: DataFrame, day: str, ret: str, weight: str, styles: list[str], group: str | None = None, cap: str | None = None, least: int = 100) -> DataFrame:
    """Weighted least squares of returns on styles (and group dummies) per session: (day, factor, ret, n, r2).

    With groups the market is the cap-weighted mean of the group coefficients, and groups are stated less the market, so
    they sum to zero by cap. Sessions with fewer than ``least`` usable rows are left out. One session is one group.
    """
    keep = [day, ret, weight, *styles, *([group] if group else []), *([cap] if cap and cap != weight else [])]
    kind = dict(df.dtypes)[day]

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[np.isfinite(rows[ret].astype(float)) & (rows[weight].astype(float) > 0)]
        if len(rows) < least:
            return pd.DataFrame(columns=[day, "factor", "ret", "n", "r2"], dtype=object)
        y, w = rows[ret].to_numpy(float), rows[weight].to_numpy(float)
        names = sorted(rows[group].dropna().unique()) if group else ["market"]
        dummies = np.column_stack([(rows[group] == g).to_numpy(float) for g in names]) if group else np.ones((len(rows), 1))
        x = np.column_stack([dummies, rows[styles].to_numpy(float)])
        root = np.sqrt(w)[:, None]
        beta = np.linalg.lstsq(x * root, y * root[:, 0], rcond=None)[0]
        out = dict(zip([*names, *styles], beta))
        if group:
            size = rows[cap or weight].to_numpy(float) @ dummies
            market = float(size @ beta[: len(names)] / size.sum())
            out = {"market": market} | {n: b - market for n, b in zip(names, beta)} | dict(zip(styles, beta[len(names) :]))
        total = (w * (y - np.average(y, weights=w)) ** 2).sum()
        r2 = 1 - (w * (y - x @ beta) ** 2).sum() / total if total > 0 else np.nan
        return pd.DataFrame({day: rows[day].iloc[0], "factor": list(out), "ret": list(out.values()), "n": len(rows), "r2": r2})

    return df.select(*keep).groupBy(day).applyInPandas(fit, f"{day} {kind}, factor string, ret double, n long, r2 double")


def newey_west(x: np.ndarray, lag: int) -> tuple[float, float]:
    """(mean, standard error) with Bartlett weights; values that are not finite are left out."""
    x = np.asarray(x, float)
    x = x[np.isfinite(x)]
    if len(x) < 2:
        return (float(x.mean()) if len(x) else np.nan), np.nan
    d = x - x.mean()
    gamma = [d[k:] @ d[: len(d) - k] / len(d) for k in range(min(lag, len(d) - 1) + 1)]
    bartlett = 1 - np.arange(len(gamma)) / (lag + 1)
    return float(x.mean()), float(np.sqrt(max(2 * np.dot(bartlett, gamma) - gamma[0], 0.0) / len(d)))


def ridge(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """(loadings, intercepts) of each column of y on x; the penalty acts on standardized x. Constant columns load 0.

    Along each singular direction of the standardized factors the least-squares loading shrinks by s^2 / (s^2 + penalty).
    """
    center, size = x.mean(axis=0), np.where(np.ptp(x, axis=0) > 0, x.std(axis=0), np.inf)
    u, s, v = np.linalg.svd((x - center) / size, full_matrices=False)
    gain = np.divide(s, s * s + penalty, out=np.zeros_like(s), where=s > 0)
    beta = (v.T @ (gain[:, None] * (u.T @ (y - y.mean(axis=0))))) / size[:, None]
    return beta, y.mean(axis=0) - center @ beta


def ridge_from_sums(n: float, sx: np.ndarray, sxx: np.ndarray, sy: float, sxy: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """(loadings, intercept) of the same ridge from sums alone: rows, x, x x', y and x y. Sums add up, so rows need not meet."""
    center = sx / n
    spread = np.sqrt(np.maximum(np.diagonal(sxx) / n - center**2, 0.0))
    size = np.where(spread > 1e-9 * np.maximum(np.abs(center), 1e-9), spread, np.inf)
    gram = (sxx - n * np.multiply.outer(center, center)) / np.multiply.outer(size, size)
    beta = np.linalg.solve(gram + penalty * np.eye(len(size)), (sxy - center * sy) / size) / size
    return beta, sy / n - center @ beta


def rolling_ridge(df: DataFrame, key: str, day: str, ret: str, factors: list[str], window: int, step: int, least: int, penalty: float) -> DataFrame:
    """Ridge loadings of each key on factor returns, refitted every ``step`` sessions on the ``window`` before it.

    Rows (key, fit_date, factor, loading); the intercept is factor ``alpha``. Each key is one group of its own history.
    """
    kinds = dict(df.dtypes)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(day).reset_index(drop=True)
        out = []
        for end in range(window, len(rows), step):
            part = rows.iloc[end - window : end].dropna(subset=[ret, *factors])
            if len(part) < least:
                continue
            beta, alpha = ridge(part[factors].to_numpy(float), part[[ret]].to_numpy(float), penalty)
            out += [(rows[key].iloc[0], rows[day].iloc[end], f, float(b)) for f, b in zip([*factors, "alpha"], [*beta[:, 0], alpha[0]])]
        return pd.DataFrame(out, columns=[key, "fit_date", "factor", "loading"])

    return df.select(key, day, ret, *factors).groupBy(key).applyInPandas(fit, f"{key} {kinds[key]}, fit_date {kinds[day]}, factor string, loading double")


def eigenportfolios(df: DataFrame, key: str, day: str, ret: str, size: str, window: int, step: int, k: int, n_names: int) -> DataFrame:
    """Out-of-sample returns of the top k eigenportfolios: (day, component, ret, share, n).

    At each rebalance the largest ``n_names`` names with a full window give a correlation matrix; a component's weights are
    its eigenvector over the names' volatilities at a gross exposure of 1 and earn the next ``step`` sessions. The fit of a
    rebalance is one group, of at most n_names names and window sessions; what weights earn is a join and a sum. The
    first component has a positive net weight; a later one starts so, and then points where the weights it shares with
    the rebalance before do. Those products come from a join of neighbours, and signs from the parity of their flips.
    """
    kinds = dict(df.dtypes)
    sessions = df.select(day).distinct().withColumn("t", F.row_number().over(Window.orderBy(day)) - 1)
    last = sessions.agg(F.max("t")).first()[0] or 0
    starts = list(range(window, last + 1, step))
    if not starts:
        return df.sparkSession.createDataFrame([], f"{day} {kinds[day]}, component int, ret double, share double, n long")
    at = F.explode(F.array(*[F.lit(s) for s in starts])).alias("start")
    near = (F.col("t") >= F.col("start") - window) & (F.col("t") < F.col("start") + step)
    rows = df.join(sessions, day).select(F.col(key).alias("name"), F.col(ret).alias("ret"), F.col(size).alias("size"), "t", at).where(near)
    whole = rows.where("t < start").groupBy("start", "name").agg(F.count("ret").alias("seen"), F.max_by("size", "t").alias("size"), F.stddev_samp("ret").alias("sd"))
    place = F.row_number().over(Window.partitionBy("start").orderBy(F.desc("size"), "name"))
    chosen = whole.where(F.col("seen") == window).withColumn("place", place).where(F.col("place") <= n_names)
    past = rows.where("t < start").join(chosen.where("sd > 0").select("start", "name", "sd"), ["start", "name"])

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["name", "t"])
        names = part["name"].unique()
        if len(names) < 2 * k:
            return pd.DataFrame({c: [] for c in ("start", "component", "name", "weight", "share", "n")})
        moves = part["ret"].to_numpy(float).reshape(len(names), -1)
        risk = part["sd"].to_numpy(float).reshape(len(names), -1)[:, 0]
        moves = (moves - moves.mean(axis=1, keepdims=True)) / risk[:, None]
        value, session = np.linalg.eigh(moves.T @ moves)
        top = np.argsort(value)[: -k - 1 : -1]
        held = moves @ session[:, top] / risk[:, None]
        held /= np.abs(held).sum(axis=0)
        net = np.where(held.sum(axis=0) < 0, -1.0, 1.0)
        share = value[top] / value.sum()
        each = len(names)
        return pd.DataFrame({"start": part["start"].iloc[0], "component": np.repeat(np.arange(k), each), "name": np.tile(names, k), "weight": (held * net).T.ravel(), "share": np.repeat(share, each), "n": each})

    weights = past.groupBy("start").applyInPandas(fit, f"start int, component int, name {kinds[key]}, weight double, share double, n long")
    turns = weights.select("start").distinct().withColumn("before", F.lag("start").over(Window.orderBy("start")))
    now = weights.where("component > 0").join(turns, "start")
    then = weights.select(F.col("start").alias("before"), "component", "name", F.col("weight").alias("old"))
    overlap = now.join(then, ["before", "component", "name"], "left").groupBy("component", "start").agg(F.sum(F.col("weight") * F.col("old")).alias("overlap"))
    so_far = Window.partitionBy("component").orderBy("start")
    flips = F.sum(F.when(F.col("overlap") < 0, 1).otherwise(0)).over(so_far)
    signs = overlap.select("start", "component", F.when(flips % 2 == 1, -1.0).otherwise(1.0).alias("sign"))
    future = rows.where("t >= start").select("start", "name", "t", "ret")
    earned = weights.join(future, ["start", "name"], "left").where("t is not null")
    earned = earned.groupBy("start", "component", "t").agg(F.sum(F.coalesce(F.col("ret") * F.col("weight"), F.lit(0.0))).alias("ret"), F.first("share").alias("share"), F.first("n").alias("n"))
    out = earned.join(signs, ["start", "component"], "left").join(sessions, "t")
    return out.select(day, "component", (F.col("ret") * F.coalesce("sign", F.lit(1.0))).alias("ret"), "share", "n")
