"""Reports for one name, a pair, a portfolio; robust cross-sections; a mimicking portfolio."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.robust import clipped, weighted_median
from ..operators.windows import ordered, safe_corr
from .panel import RETS, returns
from .registry import query


def by_key():
    return ordered(["key"], "date")


MED = f"""{RETS}, v AS (SELECT * FROM rets WHERE ret IS NOT NULL), c AS (SELECT date, ret, sum(dollar_volume) OVER (PARTITION BY date ORDER BY ret RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS below, sum(dollar_volume) OVER (PARTITION BY date) AS total FROM v), med AS (
  SELECT date, min(ret) AS med FROM c WHERE below >= 0.5 * total GROUP BY 1)"""


@query("weighted_median_return", f"WITH {MED} SELECT date, round(med, 8) AS med FROM med")
def weighted_median_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir).where("ret is not null")
    return weighted_median(rows, ["date"], "ret", "dollar_volume", "med").select("date", F.round("med", 8).alias("med"))


@query(
    "clipped_returns",
    f"""WITH {MED}, d AS (SELECT v.*, med, abs(ret - med) AS dev FROM v JOIN med USING (date)), e AS (SELECT date, dev, sum(dollar_volume) OVER (PARTITION BY date ORDER BY dev RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS below, sum(dollar_volume) OVER (PARTITION BY date) AS total FROM d), mad AS (
  SELECT date, 1.4826 * min(dev) AS mad FROM e WHERE below >= 0.5 * total GROUP BY 1)
SELECT key, date, round(CASE WHEN mad > 0 THEN least(greatest(ret, med - 3 * mad), med + 3 * mad) ELSE ret END, 10) AS clipped FROM d JOIN mad USING (date)""",
)
def clipped_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir).where("ret is not null")
    return clipped(rows, ["date"], "ret", "dollar_volume", 3.0, "clipped").select("key", "date", F.round("clipped", 10).alias("clipped"))


@query(
    "pair_report",
    f"""WITH {RETS}, p AS (SELECT a.date, a.ret AS x, b.ret AS y, a.close / b.close AS ratio FROM rets a JOIN rets b ON a.date = b.date WHERE a.key = 1 AND b.key = 2)
SELECT count(*) AS n, round(corr(x, y), 6) AS c, round(covar_pop(x, y) / nullif(var_pop(y), 0), 6) AS beta, round(avg(ratio), 6) AS mean_ratio, round((arg_max(ratio, date) - avg(ratio)) / nullif(stddev_samp(ratio), 0), 5) AS ratio_z FROM p WHERE x IS NOT NULL AND y IS NOT NULL""",
)
def pair_report(spark: SparkSession, sf_dir: str, one: int = 1, other: int = 2) -> DataFrame:
    """How two names move together and where their ratio stands; the names are parameters."""
    rows = returns(spark, sf_dir)
    a = rows.where(F.col("key") == one).select("date", F.col("ret").alias("x"), F.col("close").alias("p"))
    b = rows.where(F.col("key") == other).select("date", F.col("ret").alias("y"), F.col("close").alias("q"))
    both = a.join(b, "date").where("x is not null and y is not null").withColumn("ratio", F.col("p") / F.col("q"))
    z = F.try_divide(F.max_by("ratio", "date") - F.avg("ratio"), F.stddev_samp("ratio"))
    return both.agg(
        F.count("*").alias("n"),
        F.round(safe_corr(F.col("x"), F.col("y")), 6).alias("c"),
        F.round(F.try_divide(F.covar_pop("x", "y"), F.var_pop("y")), 6).alias("beta"),
        F.round(F.avg("ratio"), 6).alias("mean_ratio"),
        F.round(z, 5).alias("ratio_z"),
    )


@query(
    "name_profile",
    f"""WITH {RETS}, c AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY date DESC) AS back, exp(sum(ln(1 + coalesce(ret, 0))) OVER (PARTITION BY key ORDER BY date)) AS level FROM rets), d AS (SELECT *, level / max(level) OVER (PARTITION BY key ORDER BY date) - 1 AS below FROM c)
SELECT key, count(*) AS n, max(date) AS last_date, arg_max(close, date) AS last_close, round(exp(sum(ln(1 + ret)) FILTER (WHERE back <= 12)) - 1, 6) AS ret_12, round(stddev_samp(ret) * sqrt(12), 6) AS vol, round(min(below), 6) AS drawdown, round(max(ret), 6) AS best, round(min(ret), 6) AS worst FROM d GROUP BY 1""",
)
def name_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = by_key()
    rows = returns(spark, sf_dir).withColumn("back", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("date"))))
    rows = rows.withColumn("level", F.exp(F.sum(F.ln(1 + F.coalesce("ret", F.lit(0.0)))).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    rows = rows.withColumn("below", F.col("level") / F.max("level").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return rows.groupBy("key").agg(
        F.count("*").alias("n"),
        F.max("date").alias("last_date"),
        F.max_by("close", "date").alias("last_close"),
        F.round(F.exp(F.sum(F.when(F.col("back") <= 12, F.ln(1 + F.col("ret"))))) - 1, 6).alias("ret_12"),
        F.round(F.stddev_samp("ret") * F.sqrt(F.lit(12.0)), 6).alias("vol"),
        F.round(F.min("below"), 6).alias("drawdown"),
        F.round(F.max("ret"), 6).alias("best"),
        F.round(F.min("ret"), 6).alias("worst"),
    )


@query(
    "similar_by_loadings",
    f"""WITH {RETS}, m AS (SELECT date, avg(ret) AS mkt, avg(ret) FILTER (WHERE key % 2 = 0) - avg(ret) FILTER (WHERE key % 2 = 1) AS style FROM rets WHERE ret IS NOT NULL GROUP BY 1), b AS (
  SELECT key, covar_pop(ret, mkt) / nullif(var_pop(mkt), 0) * stddev_pop(mkt) AS x, covar_pop(ret, style) / nullif(var_pop(style), 0) * stddev_pop(style) AS y FROM rets JOIN m USING (date) WHERE ret IS NOT NULL GROUP BY 1), p AS (
  SELECT a.key AS a, b.key AS b, round((a.x * b.x + a.y * b.y) / nullif(sqrt(a.x * a.x + a.y * a.y) * sqrt(b.x * b.x + b.y * b.y), 0), 6) AS cosine FROM b a JOIN b ON a.key <> b.key AND a.key <= 5), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS place FROM p)
SELECT a, b, cosine FROM r WHERE place <= 3""",
)
def similar_by_loadings(spark: SparkSession, sf_dir: str, asked_for: tuple[int, ...] = tuple(range(6))) -> DataFrame:
    """The three of all names whose volatility-scaled loadings point most in the direction of each name asked for."""
    rows = returns(spark, sf_dir).where("ret is not null")
    even = F.col("key") % 2 == 0
    days = rows.groupBy("date").agg(F.avg("ret").alias("mkt"), (F.avg(F.when(even, F.col("ret"))) - F.avg(F.when(~even, F.col("ret")))).alias("style"))
    scaled = lambda f: F.try_divide(F.covar_pop("ret", f), F.var_pop(f)) * F.stddev_pop(f)
    loads = rows.join(days, "date").groupBy("key").agg(scaled("mkt").alias("x"), scaled("style").alias("y"))
    asked = loads.where(F.col("key").isin(*asked_for)).select(F.col("key").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    pairs = loads.crossJoin(F.broadcast(asked)).where("a <> key")  # five fixed names against all
    size = F.sqrt(F.col("ax") ** 2 + F.col("ay") ** 2) * F.sqrt(F.col("x") ** 2 + F.col("y") ** 2)
    pairs = pairs.select("a", F.col("key").alias("b"), F.round(F.try_divide(F.col("ax") * F.col("x") + F.col("ay") * F.col("y"), size), 6).alias("cosine"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    return pairs.withColumn("place", place).where("place <= 3").select("a", "b", "cosine")


@query("mimic_portfolio")
def mimic_portfolio(spark: SparkSession, sf_dir: str, names: tuple[int, ...] = tuple(range(1, 9))) -> DataFrame:
    """A ridge portfolio of the named assets that tracks the market out of sample, refitted every six months. No intercept is held."""
    rows = returns(spark, sf_dir).where("ret is not null")
    market = rows.groupBy("date").agg(F.avg("ret").alias("y"))
    wide = rows.where(F.col("key").isin(*names)).groupBy("date").pivot("key", list(names)).agg(F.first("ret")).join(market, "date").withColumn("one", F.lit(1))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("date").reset_index(drop=True)
        x, y = part[[str(n) for n in names]].to_numpy(float), part["y"].to_numpy(float)
        out = []
        for at in range(24, len(part), 6):
            a, b = x[at - 24 : at], y[at - 24 : at]
            ok = np.isfinite(a).all(axis=1) & np.isfinite(b)
            if ok.sum() < 12:
                continue
            a, b = a[ok], b[ok]
            mid = a - a.mean(axis=0)
            w = np.linalg.solve(mid.T @ mid + 1e-4 * (a**2).sum() / len(names) * np.eye(len(names)), mid.T @ (b - b.mean()))
            out += [(d, float(r @ w), float(t)) for d, r, t in zip(part["date"][at : at + 6], x[at : at + 6], y[at : at + 6]) if np.isfinite(r).all()]
        return pd.DataFrame(out, columns=["date", "mimic", "target"])

    found = wide.groupBy("one").applyInPandas(fit, "date date, mimic double, target double")  # one row a session
    return found.select("date", F.round("mimic", 7).alias("mimic"), F.round("target", 7).alias("target"))
