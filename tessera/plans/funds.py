"""Fund marts on brands by month: spliced returns, trends, features, holdings, gates, walk-forward models, simulated paths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import month_number
from ..operators.regress import newey_west, ridge_from_sums
from ..operators.simulate import bootstrap_paths
from ..operators.windows import average_rank, safe_corr
from .panel import table
from .registry import query

INDEX = """m AS (SELECT p_brand AS idx, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, round(sum(l_extendedprice), 2) / round(sum(l_quantity), 2) AS level FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2), i AS (
  SELECT idx, month, year(month) * 12 + month(month) AS mn, level FROM m), r AS (
  SELECT idx, month, mn, level / max(level) OVER (PARTITION BY idx ORDER BY mn RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) - 1 AS ret, 0.002 + (mn % 5) * 0.0005 AS rf FROM i)"""


def index_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly returns of brands, null after a missing month, with a made-up cash rate."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    rows = lines.groupBy(F.col("p_brand").alias("idx"), F.trunc("l_shipdate", "month").alias("month"))
    rows = rows.agg((F.round(F.sum("l_extendedprice"), 2) / F.round(F.sum("l_quantity"), 2)).alias("level")).withColumn("mn", month_number(F.col("month")).cast("long"))
    before = F.max("level").over(by_month().rangeBetween(-1, -1))
    return rows.select("idx", "month", "mn", (F.col("level") / before - 1).alias("ret"), (0.002 + (F.col("mn") % 5) * 0.0005).alias("rf"))


def by_month():
    return Window.partitionBy("idx").orderBy("mn")


@query(
    "fund_signal_history",
    f"""WITH {INDEX} SELECT idx, month, CASE WHEN count(ret) OVER a = 11 THEN round(exp(sum(ln(1 + ret)) OVER a) - 1, 6) END AS mom, CASE WHEN count(ret) OVER v >= 36 THEN round(1 - exp(sum(ln(1 + ret)) OVER v), 5) END AS val,
  CASE WHEN count(ret) OVER t = 12 THEN round(exp(sum(ln(1 + ret)) OVER t) - exp(sum(ln(1 + rf)) OVER t), 6) END AS trend, round(max(ret) OVER (PARTITION BY idx ORDER BY mn RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING), 7) AS fwd FROM r
WINDOW a AS (PARTITION BY idx ORDER BY mn RANGE BETWEEN 11 PRECEDING AND 1 PRECEDING), v AS (PARTITION BY idx ORDER BY mn RANGE BETWEEN 59 PRECEDING AND 12 PRECEDING), t AS (PARTITION BY idx ORDER BY mn RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def fund_signal_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Momentum without the last month, long reversal, and trend over cash, by month numbers."""
    a, v, t = by_month().rangeBetween(-11, -1), by_month().rangeBetween(-59, -12), by_month().rangeBetween(-11, 0)
    grown = lambda w, c="ret": F.exp(F.sum(F.ln(1 + F.col(c))).over(w))
    return index_returns(spark, sf_dir).select(
        "idx",
        "month",
        F.when(F.count("ret").over(a) == 11, F.round(grown(a) - 1, 6)).alias("mom"),
        F.when(F.count("ret").over(v) >= 36, F.round(1 - grown(v), 5)).alias("val"),
        F.when(F.count("ret").over(t) == 12, F.round(grown(t) - grown(t, "rf"), 6)).alias("trend"),
        F.round(F.max("ret").over(by_month().rangeBetween(1, 1)), 7).alias("fwd"),
    )


TREND = f"""{INDEX}, s AS (SELECT idx, month, mn, ret, rf, CASE WHEN count(ret) OVER t = 12 THEN exp(sum(ln(1 + ret)) OVER t) - exp(sum(ln(1 + rf)) OVER t) END AS trend FROM r WINDOW t AS (PARTITION BY idx ORDER BY mn RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)), n AS (
  SELECT idx, month, mn, ret, rf, max(trend) OVER (PARTITION BY idx ORDER BY mn RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) > 0 AS up FROM s)"""


def trend_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month's return with whether the trend up to the month before was up."""
    t = by_month().rangeBetween(-11, 0)
    grown = lambda c: F.exp(F.sum(F.ln(1 + F.col(c))).over(t))
    rows = index_returns(spark, sf_dir).withColumn("trend", F.when(F.count("ret").over(t) == 12, grown("ret") - grown("rf")))
    return rows.select("idx", "month", "mn", "ret", "rf", (F.max("trend").over(by_month().rangeBetween(-1, -1)) > 0).alias("up"))


@query(
    "fund_trend_summary",
    f"""WITH {TREND}, h AS (SELECT idx, ret, CASE WHEN up THEN ret ELSE rf END AS timed, up, ret - rf AS ex FROM n WHERE up IS NOT NULL AND ret IS NOT NULL)
SELECT idx, count(*) AS months, round(avg(CASE WHEN up THEN 1.0 ELSE 0.0 END), 6) AS share_up, round(exp(avg(ln(1 + ret)) * 12) - 1, 5) AS hold, round(exp(avg(ln(1 + timed)) * 12) - 1, 5) AS timed, round(avg(ex) FILTER (WHERE up) - avg(ex) FILTER (WHERE NOT up), 7) AS slope FROM h GROUP BY 1""",
)
def fund_trend_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holding throughout against holding cash after a down trend."""
    rows = trend_states(spark, sf_dir).where("up is not null and ret is not null")
    timed, excess = F.when(F.col("up"), F.col("ret")).otherwise(F.col("rf")), F.col("ret") - F.col("rf")
    yearly = lambda c: F.round(F.exp(F.avg(F.ln(1 + c)) * 12) - 1, 5)
    slope = F.avg(F.when(F.col("up"), excess)) - F.avg(F.when(~F.col("up"), excess))
    return rows.groupBy("idx").agg(F.count("*").alias("months"), F.round(F.avg(F.when(F.col("up"), 1.0).otherwise(0.0)), 6).alias("share_up"), yearly(F.col("ret")).alias("hold"), yearly(timed).alias("timed"), F.round(slope, 7).alias("slope"))


@query("fund_asset_gate")
def fund_asset_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newey-West t of the difference between returns after up and down trends, per index. Tested against a plain version."""

    def gate(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("mn")
        up, x = rows["up"].to_numpy(bool), rows["x"].to_numpy(float)
        out = {"idx": rows["idx"].iloc[0], "months": len(rows), "slope": np.nan, "t": np.nan}
        if 3 <= up.sum() <= len(up) - 3:
            slope = x[up].mean() - x[~up].mean()
            score = np.where(up, (x - x[up].mean()) / up.mean(), -(x - x[~up].mean()) / (~up).mean())
            out |= {"slope": slope, "t": slope / newey_west(score, 5)[1]}
        return pd.DataFrame([out])

    rows = trend_states(spark, sf_dir).where("up is not null and ret is not null").select("idx", "mn", "up", (F.col("ret") - F.col("rf")).alias("x"))
    return rows.groupBy("idx").applyInPandas(gate, "idx string, months long, slope double, t double").select("idx", "months", F.round("slope", 7).alias("slope"), F.round("t", 5).alias("t"))


FEATURES = f"""{INDEX}, l AS (SELECT *, count(ret) OVER y AS n12, exp(sum(ln(1 + ret)) OVER y3) - 1 AS r3, exp(sum(ln(1 + ret)) OVER y6) - 1 AS r6, stddev_samp(ret) OVER y AS vol12, max(ret) OVER (PARTITION BY idx ORDER BY mn RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS nxt FROM r
  WINDOW y AS (PARTITION BY idx ORDER BY mn RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), y3 AS (PARTITION BY idx ORDER BY mn RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), y6 AS (PARTITION BY idx ORDER BY mn RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)), f AS (
  SELECT idx, month, mn, r3, r6, vol12, nxt FROM l WHERE n12 = 12)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = by_month().rangeBetween(-11, 0)
    grown = lambda n: F.exp(F.sum(F.ln(1 + F.col("ret"))).over(by_month().rangeBetween(-(n - 1), 0))) - 1
    rows = index_returns(spark, sf_dir).withColumn("n12", F.count("ret").over(y)).withColumn("r3", grown(3)).withColumn("r6", grown(6))
    rows = rows.withColumn("vol12", F.stddev_samp("ret").over(y)).withColumn("nxt", F.max("ret").over(by_month().rangeBetween(1, 1)))
    return rows.where("n12 = 12").select("idx", "month", "mn", "r3", "r6", "vol12", "nxt")


@query(
    "fund_features",
    f"WITH {FEATURES} SELECT idx, month, round(r3, 6) AS r3, round(r6, 6) AS r6, round(vol12, 7) AS vol12, round(nxt - avg(nxt) OVER (PARTITION BY month), 7) AS target FROM f",
)
def fund_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each index and month with the next return less that month's mean over indexes."""
    target = F.col("nxt") - F.avg("nxt").over(Window.partitionBy("month"))
    return features(spark, sf_dir).select("idx", "month", F.round("r3", 6).alias("r3"), F.round("r6", 6).alias("r6"), F.round("vol12", 7).alias("vol12"), F.round(target, 7).alias("target"))


@query(
    "path_drawdown",
    f"""WITH {INDEX}, p AS (SELECT a.idx, a.month, b.mn, exp(sum(ln(1 + b.ret)) OVER (PARTITION BY a.idx, a.mn ORDER BY b.mn)) AS wealth FROM r a JOIN r b ON a.idx = b.idx AND b.mn BETWEEN a.mn - 11 AND a.mn WHERE b.ret IS NOT NULL), q AS (
  SELECT idx, month, wealth / greatest(1, max(wealth) OVER (PARTITION BY idx, month ORDER BY mn)) - 1 AS below FROM p)
SELECT idx, month, round(min(below), 6) AS dd12 FROM q GROUP BY 1, 2 HAVING count(*) = 12""",
)
def path_drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deepest fall within the last twelve months, from each month's own list of returns."""
    rows = index_returns(spark, sf_dir)
    path = F.collect_list(F.when(F.col("ret").isNotNull(), F.ln(1 + F.col("ret")))).over(by_month().rangeBetween(-11, 0))
    fall = F.aggregate(
        "path",
        F.struct(F.lit(0.0).alias("level"), F.lit(0.0).alias("peak"), F.lit(0.0).alias("low")),
        lambda s, x: F.struct((s["level"] + x).alias("level"), F.greatest(s["peak"], s["level"] + x).alias("peak"), F.least(s["low"], s["level"] + x - F.greatest(s["peak"], s["level"] + x)).alias("low")),
        lambda s: F.exp(s["low"]) - 1,
    )
    return rows.withColumn("path", path).where(F.size("path") == 12).select("idx", "month", F.round(fall, 6).alias("dd12"))


@query(
    "fund_signal_ic",
    f"""WITH {FEATURES}, k AS (SELECT month, (rank() OVER a + count(*) OVER (PARTITION BY month ORDER BY round(r6, 9) RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2.0 AS rs, (rank() OVER b + count(*) OVER (PARTITION BY month ORDER BY round(nxt, 9) RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2.0 AS rn FROM f WHERE nxt IS NOT NULL WINDOW a AS (PARTITION BY month ORDER BY round(r6, 9)), b AS (PARTITION BY month ORDER BY round(nxt, 9)))
SELECT month, count(*) AS n, round(corr(rs, rn), 6) AS ic FROM k GROUP BY 1 HAVING count(*) >= 5""",
)
def fund_signal_ic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir).where("nxt is not null").select("month", F.round("r6", 9).alias("s"), F.round("nxt", 9).alias("x"))
    rows = rows.select("month", average_rank(["month"], "s").alias("rs"), average_rank(["month"], "x").alias("rn"))
    return rows.groupBy("month").agg(F.count("*").alias("n"), F.round(safe_corr(F.col("rs"), F.col("rn")), 6).alias("ic")).where("n >= 5")


@query("fund_ridge_scores")
def fund_ridge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk-forward ridge of the demeaned next return on ranked features, refitted yearly on earlier years only, from sums by year."""
    names = ["r3", "r6", "vol12"]
    rows = features(spark, sf_dir).withColumn("n", F.count("*").over(Window.partitionBy("month")))
    scaled = [(average_rank(["month"], c) / (F.col("n") + 1) - 0.5).alias(c) for c in names]
    rows = rows.select("idx", "month", "mn", (F.col("nxt") - F.avg("nxt").over(Window.partitionBy("month"))).alias("y"), *scaled)
    years = [r[0] for r in rows.select(F.year("month")).distinct().collect()]
    plans = spark.createDataFrame([(y,) for y in sorted(years)[2:]], "fit_year int")
    # A label ends a month after its row, so December belongs to the next year.
    known = rows.where("y is not null").withColumn("first_use", F.year(F.add_months("month", 1)) + 1)
    cells = {"n": F.lit(1.0), "sy": F.col("y")} | {f"s_{a}": F.col(a) for a in names} | {f"y_{a}": F.col(a) * F.col("y") for a in names}
    cells |= {f"q_{a}_{b}": F.col(a) * F.col(b) for a in names for b in names}
    yearly = known.groupBy("first_use").agg(*[F.sum(c).alias(k) for k, c in cells.items()])
    so_far = yearly.join(F.broadcast(plans), F.col("first_use") <= F.col("fit_year")).groupBy("fit_year").agg(*[F.sum(k).alias(k) for k in cells])  # both a row a year

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for r in part.to_dict("records"):
                if r["n"] >= 20:
                    sx, sxy = (np.array([r[f"{p}_{a}"] for a in names]) for p in "sy")
                    beta, alpha = ridge_from_sums(r["n"], sx, np.array([[r[f"q_{a}_{b}"] for b in names] for a in names]), r["sy"], sxy, 10.0)
                    out.append((r["fit_year"], alpha, *beta.tolist()))
            yield pd.DataFrame(out, columns=["fit_year", "alpha", *[f"b_{a}" for a in names]])

    fits = so_far.mapInPandas(solve, f"fit_year int, alpha double, {', '.join(f'b_{a} double' for a in names)}")
    score = sum((F.col(a) * F.col(f"b_{a}") for a in names), F.col("alpha"))
    return rows.join(fits, F.year("month") == F.col("fit_year")).select("idx", "month", F.round(score, 8).alias("score"))


@query(
    "spliced_returns",
    f"""WITH {INDEX}, own AS (SELECT p_type AS fund, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(DISTINCT CAST(l_shipdate AS DATE)) AS days, arg_max(l_extendedprice, struct_pack(a := l_shipdate, b := l_orderkey, c := l_extendedprice)) AS last FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2), o AS (
  SELECT fund, month, days, last / lag(last) OVER w - 1 AS ret, lag(month) OVER w AS prev FROM own WINDOW w AS (PARTITION BY fund ORDER BY month)), x AS (SELECT month, ret FROM r WHERE idx = (SELECT min(idx) FROM r))
SELECT fund, o.month, CASE WHEN days >= 28 AND prev = o.month - INTERVAL 1 MONTH THEN round(o.ret, 8) ELSE round(x.ret, 8) END AS ret, coalesce(days >= 28 AND prev = o.month - INTERVAL 1 MONTH, false) AS own FROM o LEFT JOIN x ON x.month = o.month""",
)
def spliced_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fund's own return where its month is whole and the month before is there, else that of its index."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
    last = F.max_by("l_extendedprice", F.struct("l_shipdate", "l_orderkey", "l_extendedprice"))
    own = lines.groupBy(F.col("p_type").alias("fund"), F.trunc("l_shipdate", "month").alias("month")).agg(F.countDistinct(F.col("l_shipdate").cast("date")).alias("days"), last.alias("last"))
    w = Window.partitionBy("fund").orderBy("month")
    own = own.select("fund", "month", "days", (F.col("last") / F.lag("last").over(w) - 1).alias("own_ret"), F.lag("month").over(w).alias("prev"))
    rows = index_returns(spark, sf_dir)
    first = rows.agg(F.min("idx").alias("idx"))
    mapped = rows.join(F.broadcast(first), "idx").select("month", F.col("ret").alias("idx_ret"))  # one row
    whole = F.coalesce((F.col("days") >= 28) & (F.col("prev") == F.add_months("month", -1)), F.lit(False))
    return own.join(mapped, "month", "left").select("fund", "month", F.round(F.when(whole, F.col("own_ret")).otherwise(F.col("idx_ret")), 8).alias("ret"), whole.alias("own"))


@query(
    "segment_returns",
    f"""WITH {INDEX}, k AS (SELECT substr(idx, 1, 7) AS segment, month, count(*) AS n, count(ret) AS have, avg(ret) AS ret FROM r GROUP BY 1, 2), s AS (SELECT substr(idx, 1, 7) AS segment, count(DISTINCT idx) AS needed FROM r GROUP BY 1)
SELECT segment, month, round(ret, 9) AS ret FROM k JOIN s USING (segment) WHERE have = needed""",
)
def segment_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean return of a segment's indexes, only for months in which all of them have one."""
    rows = index_returns(spark, sf_dir).withColumn("segment", F.substring("idx", 1, 7))
    needed = rows.groupBy("segment").agg(F.countDistinct("idx").alias("needed"))
    means = rows.groupBy("segment", "month").agg(F.count("ret").alias("have"), F.avg("ret").alias("ret"))
    return means.join(needed, "segment").where("have = needed").select("segment", "month", F.round("ret", 9).alias("ret"))


@query(
    "holdings_weights",
    """WITH v AS (SELECT l_suppkey AS fund, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS report, l_partkey AS line, sum(l_extendedprice) AS val, l_partkey % 10 <> 0 AS mapped FROM lineitem GROUP BY 1, 2, 3)
SELECT fund, report, count(*) AS lines, round(sum(val) FILTER (WHERE mapped) / sum(val), 7) AS covered, round(max(val) / sum(val), 7) AS largest, count(*) FILTER (WHERE mapped) AS mapped_lines FROM v GROUP BY 1, 2""",
)
def holdings_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value of each report that maps to known lines, and the largest weight."""
    lines = table(spark, sf_dir, "lineitem")
    value = lines.groupBy(F.col("l_suppkey").alias("fund"), F.trunc("l_shipdate", "quarter").alias("report"), F.col("l_partkey").alias("line")).agg(F.sum("l_extendedprice").alias("val"))
    mapped = F.col("line") % 10 != 0
    total = F.sum("val")
    return value.groupBy("fund", "report").agg(F.count("*").alias("lines"), F.round(F.sum(F.when(mapped, F.col("val"))) / total, 7).alias("covered"), F.round(F.max("val") / total, 7).alias("largest"), F.count_if(mapped).alias("mapped_lines"))


@query(
    "piece_costs",
    f"""WITH {INDEX}, g AS (SELECT idx, min(month) AS a, max(month) AS b, count(*) AS n, sum(ln(1 + ret)) AS own, sum(ln(1 + rf)) AS cash FROM r WHERE ret IS NOT NULL GROUP BY 1), ga AS (SELECT avg(own) AS all_own FROM g)
SELECT idx, n, round((own - all_own - cash) / (datediff('day', a, b) / 365.25), 6) AS gap FROM g, ga WHERE b > a""",
)
def piece_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each index lost a year against the mean and cash."""
    rows = index_returns(spark, sf_dir).where("ret is not null").groupBy("idx")
    grown = rows.agg(F.min("month").alias("a"), F.max("month").alias("b"), F.count("*").alias("n"), F.sum(F.ln(1 + F.col("ret"))).alias("own"), F.sum(F.ln(1 + F.col("rf"))).alias("cash")).where("b > a")
    years = F.datediff("b", "a") / 365.25
    return grown.crossJoin(F.broadcast(grown.agg(F.avg("own").alias("all_own")))).select("idx", "n", F.round((F.col("own") - F.col("all_own") - F.col("cash")) / years, 6).alias("gap"))


@query("bootstrap_outcomes")
def bootstrap_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of a fixed mix of four indexes over 1,000 bootstrapped paths of five years."""
    rows = index_returns(spark, sf_dir).where("ret is not null")
    names = [r[0] for r in rows.select("idx").distinct().orderBy("idx").limit(4).collect()]
    wide = rows.where(F.col("idx").isin(names)).groupBy("mn").pivot("idx", names).agg(F.first("ret")).orderBy("mn").toPandas()[names].dropna()
    paths = bootstrap_paths(spark, wide.to_numpy(float) * 0.1, np.full(len(names), 1 / len(names)), 1000, 60, 12)
    return paths.agg(*[F.round(F.percentile("final", q), 6).alias(f"final_{int(q * 100)}") for q in (0.05, 0.5, 0.95)], F.round(F.avg("drawdown"), 6).alias("mean_drawdown"), F.count("*").alias("paths"))
