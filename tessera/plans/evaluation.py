"""Signals beside the panel's own, labels, evaluation by folds, long-short curves and their costs, risk of factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import asof_join, trailing_sum
from ..operators.reshape import unpivot_known
from ..operators.windows import ordered, rolling_corr, safe_corr, trailing
from .monitor import DAILY, TENORS, daily
from .panel import RETS, returns, table
from .registry import query
from .research import IC_SQL, LONG_SQL, by_key, daily_ic, ranked_panel

#: The share of a session's labels that winsorizing clips on each side.
WINSOR = 0.05
#: The folds of development; the next one is the holdout.
FOLDS = 4


@query(
    "signals_open_dividend_short",
    f"""WITH {RETS}, o AS (
  SELECT l_suppkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, round(sum(l_extendedprice), 2) / round(sum(l_quantity), 2) AS open FROM lineitem WHERE day(l_shipdate) <= 10 GROUP BY 1, 2), b AS (
  SELECT r.key, r.date, r.close, r.ret, r.dollar_volume, o.open, lag(r.close) OVER (PARTITION BY r.key ORDER BY r.date) AS before FROM rets r LEFT JOIN o USING (key, date)), d AS (
  SELECT b.key, b.date, coalesce(sum(l_tax), 0) AS paid FROM b LEFT JOIN lineitem ON l_suppkey = b.key AND l_returnflag = 'A' AND CAST(l_shipdate AS DATE) <= b.date AND CAST(l_shipdate AS DATE) > b.date - INTERVAL 365 DAY GROUP BY 1, 2), si AS (
  SELECT l_suppkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS settled, sum(l_quantity) AS si, count(*) AS lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), s AS (
  SELECT si.key, settled, settled + 10 AS known_on, si, si * close / dollar_volume AS share, si / (lines * 20.0) AS days, lag(si) OVER w AS prev, lag(settled) OVER w AS prev_settled
  FROM si JOIN b ON b.key = si.key AND b.date = si.settled WINDOW w AS (PARTITION BY si.key ORDER BY settled))
SELECT b.key, b.date, round(stddev_samp(ret) OVER (PARTITION BY b.key ORDER BY b.date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), 8) AS vol_60, round(open / before - 1, 8) AS overnight_ret, round(close / open - 1, 8) AS intraday_ret,
  round(paid / close, 9) AS dividend_yield, CASE WHEN datediff('day', known_on, b.date) <= 45 THEN round(share, 9) END AS short_ratio, CASE WHEN datediff('day', known_on, b.date) <= 45 THEN round(days, 6) END AS days_to_cover,
  CASE WHEN datediff('day', known_on, b.date) <= 45 AND datediff('day', prev_settled, settled) <= 35 AND si > 0 AND prev > 0 THEN round(ln(si / prev), 7) END AS short_change
FROM b JOIN d ON d.key = b.key AND d.date = b.date ASOF LEFT JOIN s ON s.key = b.key AND s.known_on <= b.date""",
)
def signals_open_dividend_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volatility over 60 rows, overnight and intraday returns, trailing payments over price, and short positions as last known."""
    lines = table(spark, sf_dir, "lineitem").withColumn("key", F.col("l_suppkey").cast("long"))
    month = F.trunc("l_shipdate", "month")
    opens = lines.where(F.dayofmonth("l_shipdate") <= 10).groupBy("key", month.alias("date")).agg((F.round(F.sum("l_extendedprice"), 2) / F.round(F.sum("l_quantity"), 2)).alias("open"))
    base = returns(spark, sf_dir).select("key", "date", "close", "ret", "dollar_volume").join(opens, ["key", "date"], "left")
    base = base.withColumn("before", F.lag("close").over(by_key())).withColumn("vol", F.stddev_samp("ret").over(trailing(by_key(), 60)))
    paid = lines.where("l_returnflag = 'A'").select("key", F.col("l_shipdate").cast("date").alias("on"), "l_tax")
    base = trailing_sum(base, paid, ["key"], "date", "on", "l_tax", 365, "paid")
    held = lines.where("l_returnflag = 'R'").groupBy("key", month.alias("settled")).agg(F.sum("l_quantity").alias("si"), F.count("*").alias("lines"))
    priced = held.join(base.select("key", F.col("date").alias("settled"), "close", "dollar_volume"), ["key", "settled"])
    w = ordered(["key"], "settled")
    short = priced.select("key", "settled", F.date_add("settled", 10).alias("known_on"), "si", (F.col("si") * F.col("close") / F.col("dollar_volume")).alias("share"), (F.col("si") / (F.col("lines") * 20.0)).alias("days"), F.lag("si").over(w).alias("prev"), F.lag("settled").over(w).alias("prev_settled"))
    rows = asof_join(base, short, "date", "known_on", ["key"])
    fresh = F.datediff("date", "known_on") <= 45
    near = fresh & (F.datediff("settled", "prev_settled") <= 35) & (F.col("si") > 0) & (F.col("prev") > 0)
    return rows.select(
        "key",
        "date",
        F.round("vol", 8).alias("vol_60"),
        F.round(F.col("open") / F.col("before") - 1, 8).alias("overnight_ret"),
        F.round(F.col("close") / F.col("open") - 1, 8).alias("intraday_ret"),
        F.round(F.col("paid") / F.col("close"), 9).alias("dividend_yield"),
        F.when(fresh, F.round("share", 9)).alias("short_ratio"),
        F.when(fresh, F.round("days", 6)).alias("days_to_cover"),
        F.when(near, F.round(F.ln(F.col("si") / F.col("prev")), 7)).alias("short_change"),
    )


@query(
    "forward_labels",
    f"""WITH {RETS} SELECT key, date, round(lead(close, 1) OVER w / close - 1, 8) AS fwd_1, round(lead(close, 5) OVER w / close - 1, 8) AS fwd_5, round(lead(close, 21) OVER w / close - 1, 8) AS fwd_21 FROM rets WINDOW w AS (PARTITION BY key ORDER BY date)""",
)
def forward_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change of close over the next 1, 5 and 21 rows, null where they are not there yet."""
    ahead = [F.round(F.lead("close", n).over(by_key()) / F.col("close") - 1, 8).alias(f"fwd_{n}") for n in (1, 5, 21)]
    return returns(spark, sf_dir).select("key", "date", *ahead)


PERIODS_SQL = f"""{IC_SQL}, f AS (SELECT date, CASE WHEN ntile(10) OVER (ORDER BY date) >= 9 THEN 5 ELSE (ntile(10) OVER (ORDER BY date) + 1) // 2 END AS fold FROM (SELECT DISTINCT date FROM panel) t), ses AS (
  SELECT date, fold, lead(fold, 1) OVER (ORDER BY date) AS label_fold FROM f), used AS (
  SELECT signal, date, ic, 0 AS period FROM ics JOIN ses USING (date) WHERE fold <= 4 AND label_fold <= 4 UNION ALL
  SELECT signal, date, ic, fold FROM ics JOIN ses USING (date) WHERE fold = label_fold), span AS (
  SELECT signal, period, min(date) AS first_date, max(date) AS last_date, count(ic) AS n_days, avg(ic) AS mean, stddev_samp(ic) AS sd FROM used GROUP BY 1, 2), dev AS (
  SELECT signal, period, u.ic, u.ic - mean AS d, date FROM used u JOIN span USING (signal, period) WHERE u.ic IS NOT NULL), lags AS (
  SELECT signal, period, d * d AS g0, d * lag(d, 1) OVER w AS g1, d * lag(d, 2) OVER w AS g2, d * lag(d, 3) OVER w AS g3, d * lag(d, 4) OVER w AS g4, d * lag(d, 5) OVER w AS g5, ic, lag(ic) OVER w AS prev FROM dev WINDOW w AS (PARTITION BY signal, period ORDER BY date)), nw AS (
  SELECT signal, period, sum(g0) + 2 * (coalesce(sum(g1), 0) * 5 / 6 + coalesce(sum(g2), 0) * 4 / 6 + coalesce(sum(g3), 0) * 3 / 6 + coalesce(sum(g4), 0) * 2 / 6 + coalesce(sum(g5), 0) * 1 / 6) AS s,
    covar_pop(ic, prev) FILTER (WHERE prev IS NOT NULL) / nullif(sqrt(var_pop(ic) FILTER (WHERE prev IS NOT NULL) * var_pop(prev)), 0) AS ac1 FROM lags GROUP BY 1, 2), stats AS (
  SELECT signal, period, first_date, last_date, n_days, CASE WHEN n_days >= 3 THEN round(mean, 6) END AS mean_ic, CASE WHEN n_days >= 3 THEN round(sd, 6) END AS ic_std,
    CASE WHEN n_days >= 3 THEN round(mean / nullif(sd / sqrt(n_days), 0), 4) END AS t_naive, CASE WHEN n_days >= 3 THEN round(mean / nullif(sqrt(greatest(s, 0)) / n_days, 0), 4) END AS t_nw, CASE WHEN n_days >= 3 THEN round(ac1, 5) END AS ic_autocorr_lag1 FROM span LEFT JOIN nw USING (signal, period))"""


def ic_periods(spark: SparkSession, sf_dir: str, lag: int = 5) -> DataFrame:
    """Statistics of the daily IC by signal and period: 0 is all of development, 1 to FOLDS its folds, FOLDS + 1 the holdout.

    A session counts in a period if the end of its label lies there too. Fewer than three ICs have a count alone.
    """
    order = Window.orderBy("date")  # one row a session
    dates = returns(spark, sf_dir).select("date").distinct()
    ten = F.ntile(10).over(order)
    sessions = dates.select("date", F.when(ten > 2 * FOLDS, FOLDS + 1).otherwise(F.floor((ten + 1) / 2)).cast("long").alias("fold"))
    sessions = sessions.withColumn("label_fold", F.lead("fold").over(order))
    whole = (F.col("fold") <= FOLDS) & (F.col("label_fold") <= FOLDS)
    periods = F.array_compact(F.array(F.when(whole, F.lit(0)), F.when(F.col("fold") == F.col("label_fold"), F.col("fold").cast("int"))))
    used = daily_ic(spark, sf_dir).join(sessions.select("date", F.explode(periods).alias("period")), "date")
    own = Window.partitionBy("signal", "period")
    w = own.orderBy(F.col("ic").isNull(), "date")  # nulls last, so lags are between known days
    rows = used.select("signal", "period", "date", "ic", F.lag("ic").over(w).alias("prev"), (F.col("ic") - F.avg("ic").over(own)).alias("d"))
    rows = rows.withColumn("prev", F.when(F.col("ic").isNotNull(), F.col("prev")))
    rows = rows.select("*", *[(F.col("d") * F.lag("d", k).over(w)).alias(f"g{k}") for k in range(lag + 1)])
    total = sum((F.coalesce(F.sum(f"g{k}"), F.lit(0.0)) * (2.0 * (lag + 1 - k) / (lag + 1)) for k in range(1, lag + 1)), F.sum("g0"))
    after = F.when(F.col("prev").isNotNull(), F.col("ic"))
    stats = rows.groupBy("signal", "period").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("ic").alias("n_days"),
        F.avg("ic").alias("mean"),
        F.stddev_samp("ic").alias("sd"),
        total.alias("s"),
        safe_corr(after, F.col("prev")).alias("ac1"),
    )
    told = {
        "mean_ic": F.round("mean", 6),
        "ic_std": F.round("sd", 6),
        "t_naive": F.round(F.try_divide(F.col("mean"), F.col("sd") / F.sqrt("n_days")), 4),
        "t_nw": F.round(F.try_divide(F.col("mean"), F.sqrt(F.greatest("s", F.lit(0.0))) / F.col("n_days")), 4),
        "ic_autocorr_lag1": F.round("ac1", 5),
    }
    return stats.select("signal", "period", "first_date", "last_date", "n_days", *[F.when(F.col("n_days") >= 3, c).alias(n) for n, c in told.items()])


@query(
    "signal_ic_folds",
    f"""WITH {PERIODS_SQL}, x AS (SELECT *, max(CASE WHEN period = 0 THEN mean_ic END) OVER (PARTITION BY signal) AS whole FROM stats WHERE period <= 4)
SELECT signal, CAST(period AS INT) AS period, first_date, last_date, n_days, mean_ic, ic_std, t_naive, t_nw, ic_autocorr_lag1,
  CASE WHEN period = 0 THEN CAST(sum(CASE WHEN period > 0 AND sign(mean_ic) = sign(whole) THEN 1 ELSE 0 END) OVER (PARTITION BY signal) AS BIGINT) END AS folds_same_sign FROM x""",
)
def signal_ic_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IC of each signal over development and its folds, and how many folds agree in sign with the whole."""
    own = Window.partitionBy("signal")
    rows = ic_periods(spark, sf_dir).where(F.col("period") <= FOLDS)
    whole = F.max(F.when(F.col("period") == 0, F.col("mean_ic"))).over(own)
    agrees = (F.col("period") > 0) & (F.signum("mean_ic") == F.signum("whole"))
    same = F.sum(F.when(agrees, 1).otherwise(0)).over(own)
    return rows.withColumn("whole", whole).withColumn("folds_same_sign", F.when(F.col("period") == 0, same)).drop("whole")


@query("signal_ic_holdout", f"WITH {PERIODS_SQL} SELECT signal, first_date, last_date, n_days, mean_ic, t_nw FROM stats WHERE period = 5")
def signal_ic_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ic_periods(spark, sf_dir).where(F.col("period") == FOLDS + 1).select("signal", "first_date", "last_date", "n_days", "mean_ic", "t_nw")


CURVES_SQL = f"""{LONG_SQL}, bins AS (SELECT *, min(quintile) OVER w AS low, max(quintile) OVER w AS high FROM placed WINDOW w AS (PARTITION BY signal, date)), caps AS (
  SELECT signal, date, quantile_cont(fwd_1, {WINSOR}) AS lo, quantile_cont(fwd_1, {1 - WINSOR}) AS hi FROM bins WHERE fwd_1 IS NOT NULL GROUP BY 1, 2), dayly AS (
  SELECT signal, date, avg(fwd_1) FILTER (WHERE quintile = high) - avg(fwd_1) FILTER (WHERE quintile = low AND low < high) AS ret,
    avg(least(greatest(fwd_1, lo), hi)) FILTER (WHERE quintile = high) - avg(least(greatest(fwd_1, lo), hi)) FILTER (WHERE quintile = low AND low < high) AS ret_w
  FROM bins JOIN caps USING (signal, date) WHERE fwd_1 IS NOT NULL GROUP BY 1, 2)"""


def long_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each session's mean label of the highest quintile with names less that of the lowest, as it is and winsorized."""
    own = Window.partitionBy("signal", "date")
    rows = ranked_panel(spark, sf_dir).withColumn("low", F.min("quintile").over(own)).withColumn("high", F.max("quintile").over(own)).where("fwd_1 is not null")
    caps = rows.groupBy("signal", "date").agg(F.percentile("fwd_1", WINSOR).alias("lo"), F.percentile("fwd_1", 1 - WINSOR).alias("hi"))
    rows = rows.join(caps, ["signal", "date"]).withColumn("clipped", F.least(F.greatest("fwd_1", "lo"), F.col("hi")))
    top, bottom = F.col("quintile") == F.col("high"), (F.col("quintile") == F.col("low")) & (F.col("low") < F.col("high"))
    spread = lambda c: F.avg(F.when(top, F.col(c))) - F.avg(F.when(bottom, F.col(c)))
    return rows.groupBy("signal", "date").agg(spread("fwd_1").alias("ret"), spread("clipped").alias("ret_w"))


@query(
    "long_short_curve",
    f"WITH {CURVES_SQL} SELECT signal, date, round(ret, 7) AS ret, round(sum(ret) OVER (PARTITION BY signal ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_ret, round(ret_w, 7) AS ret_winsorized FROM dayly",
)
def long_short_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    so_far = ordered(["signal"], "date").rowsBetween(Window.unboundedPreceding, 0)
    return long_short(spark, sf_dir).select("signal", "date", F.round("ret", 7).alias("ret"), F.round(F.sum("ret").over(so_far), 6).alias("cum_ret"), F.round("ret_w", 7).alias("ret_winsorized"))


@query(
    "long_short_net",
    f"""WITH {CURVES_SQL}, legs AS (SELECT signal, date, key, CASE WHEN quintile = high THEN 'top' WHEN quintile = low THEN 'bottom' END AS leg FROM bins WHERE quintile IN (low, high)), s AS (
  SELECT date, row_number() OVER (ORDER BY date) AS rn FROM (SELECT DISTINCT date FROM legs) t), num AS (SELECT l.*, rn FROM legs l JOIN s USING (date)), size AS (SELECT signal, leg, rn, count(*) AS n FROM num GROUP BY 1, 2, 3), moves AS (
  SELECT coalesce(c.signal, p.signal) AS signal, coalesce(c.leg, p.leg) AS leg, coalesce(c.rn, p.rn + 1) AS rn, coalesce(c.key, p.key) AS key, p.key IS NULL AS enters FROM num c FULL JOIN num p ON p.signal = c.signal AND p.leg = c.leg AND p.key = c.key AND p.rn = c.rn - 1 WHERE c.key IS NULL OR p.key IS NULL), priced AS (
  SELECT m.*, s.date, coalesce(1.0 / (100 * x.n_lines), 0.01) AS spread FROM moves m JOIN s USING (rn) LEFT JOIN panel x ON x.key = m.key AND x.date = s.date WHERE m.rn > 1), costs AS (
  SELECT p.signal, p.date, p.leg, coalesce(sum(spread / 2 / a.n) FILTER (WHERE enters), 0) + coalesce(sum(spread / 2 / b.n) FILTER (WHERE NOT enters), 0) AS cost, count(*) FILTER (WHERE enters) / any_value(a.n) AS moved FROM priced p JOIN size a ON a.signal = p.signal AND a.leg = p.leg AND a.rn = p.rn LEFT JOIN size b ON b.signal = p.signal AND b.leg = p.leg AND b.rn = p.rn - 1 GROUP BY 1, 2, 3)
SELECT d.signal, d.date, round(any_value(ret), 7) AS gross, round(coalesce(sum(cost), 0), 8) AS cost, round(any_value(ret) - coalesce(sum(cost), 0), 7) AS net, round(avg(moved), 6) AS turnover FROM dayly d LEFT JOIN costs c ON c.signal = d.signal AND c.date = d.date WHERE ret IS NOT NULL GROUP BY 1, 2""",
)
def long_short_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-short returns less half a spread for every name that enters or leaves a leg; building the first legs is free."""
    own = Window.partitionBy("signal", "date")
    rows = ranked_panel(spark, sf_dir).withColumn("low", F.min("quintile").over(own)).withColumn("high", F.max("quintile").over(own))
    leg = F.when(F.col("quintile") == F.col("high"), "top").when(F.col("quintile") == F.col("low"), "bottom")
    legs = rows.select("signal", "date", "key", leg.alias("leg")).where("leg is not null")
    sessions = legs.select("date").distinct().withColumn("rn", F.row_number().over(Window.orderBy("date")).cast("long"))  # one row a session
    now = legs.join(sessions, "date").select("signal", "leg", "rn", "key")
    names = now.groupBy("signal", "leg", "rn").agg(F.count("*").alias("n"))
    before = now.withColumn("rn", F.col("rn") + 1).withColumn("was", F.lit(True))
    both = now.withColumn("is", F.lit(True)).join(before, ["signal", "leg", "rn", "key"], "full").where("rn > 1 and (is is null or was is null)")
    moves = both.select("signal", "leg", "rn", "key", F.col("was").isNull().alias("enters")).join(sessions, "rn")
    lines = returns(spark, sf_dir).select("key", "date", "n_lines")
    priced = moves.join(lines, ["key", "date"], "left").withColumn("half", F.coalesce(1 / (100 * F.col("n_lines")), F.lit(0.01)) / 2)
    sized = priced.join(names, ["signal", "leg", "rn"]).join(names.select("signal", "leg", (F.col("rn") + 1).alias("rn"), F.col("n").alias("n_before")), ["signal", "leg", "rn"], "left")
    paid = F.sum(F.col("half") / F.when(F.col("enters"), F.col("n")).otherwise(F.col("n_before")))
    costs = sized.groupBy("signal", "date", "leg").agg(F.coalesce(paid, F.lit(0.0)).alias("cost"), (F.count_if("enters") / F.first("n")).alias("moved"))
    costs = costs.groupBy("signal", "date").agg(F.sum("cost").alias("cost"), F.avg("moved").alias("moved"))
    out = long_short(spark, sf_dir).where("ret is not null").join(costs, ["signal", "date"], "left").withColumn("cost", F.coalesce("cost", F.lit(0.0)))
    return out.select("signal", "date", F.round("ret", 7).alias("gross"), F.round("cost", 8).alias("cost"), F.round(F.col("ret") - F.col("cost"), 7).alias("net"), F.round("moved", 6).alias("turnover"))


@query(
    "factor_risk",
    f"""WITH {RETS}, mkt AS (SELECT date, avg(ret) AS mret FROM rets WHERE ret IS NOT NULL GROUP BY 1), roll AS (
  SELECT key, date, ret, CASE WHEN count(ret) OVER v >= 2 THEN round(stddev_samp(ret) OVER v * sqrt(12), 8) END AS vol, CASE WHEN count(ret) OVER v >= 12 THEN covar_pop(ret, mret) OVER v / nullif(sqrt(var_pop(ret) OVER v * var_pop(mret) OVER v), 0) END AS c,
    exp(sum(ln(1 + ret)) OVER (PARTITION BY key ORDER BY date)) AS level, row_number() OVER (PARTITION BY key ORDER BY date DESC) AS back FROM rets JOIN mkt USING (date) WHERE ret IS NOT NULL WINDOW v AS (PARTITION BY key ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)), dd AS (
  SELECT *, round(level / max(level) OVER (PARTITION BY key ORDER BY date) - 1, 8) AS below FROM roll), last AS (SELECT * FROM dd WHERE back = 1), month AS (SELECT key, level AS old FROM dd WHERE back = 4), h AS (
  SELECT d.key, avg(CASE WHEN d.vol <= l.vol THEN 1.0 ELSE 0.0 END) FILTER (WHERE d.vol IS NOT NULL) AS vp, avg(CASE WHEN d.below >= l.below THEN 1.0 ELSE 0.0 END) AS dp, min(d.below) AS worst FROM dd d JOIN last l USING (key) GROUP BY 1)
SELECT key, date AS last_date, round(level / old - 1, 7) AS ret_3, round(vol, 7) AS vol, round(vp, 6) AS vol_pctile, round(below, 7) AS drawdown, round(dp, 6) AS dd_pctile, round(worst, 7) AS max_drawdown, round(c, 6) AS market_corr FROM last JOIN h USING (key) LEFT JOIN month USING (key)""",
)
def factor_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each series' volatility and drawdown stand in their own history, by two windows and one join on the last row."""
    rows = returns(spark, sf_dir).where("ret is not null").select("key", "date", "ret")
    rows = rows.join(rows.groupBy("date").agg(F.avg("ret").alias("mret")), "date")
    v, so_far = trailing(by_key(), 21), by_key().rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("vol", F.when(F.count("ret").over(v) >= 2, F.round(F.stddev_samp("ret").over(v) * 12**0.5, 8))).withColumn("c", rolling_corr("ret", "mret", v, 12))
    rows = rows.withColumn("level", F.exp(F.sum(F.ln(1 + F.col("ret"))).over(so_far)))
    rows = rows.withColumn("below", F.round(F.col("level") / F.max("level").over(so_far) - 1, 8)).withColumn("back", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("date"))))
    own = Window.partitionBy("key")
    at_last = lambda c: F.max(F.when(F.col("back") == 1, F.col(c))).over(own)
    rows = rows.withColumn("vol_now", at_last("vol")).withColumn("below_now", at_last("below"))
    share = lambda hit: F.when(hit, 1.0).otherwise(0.0)
    pick = lambda c, back: F.max(F.when(F.col("back") == back, F.col(c)))
    return rows.groupBy("key").agg(
        F.max("date").alias("last_date"),
        F.round(pick("level", 1) / pick("level", 4) - 1, 7).alias("ret_3"),
        F.round(pick("vol", 1), 7).alias("vol"),
        F.round(F.avg(F.when(F.col("vol").isNotNull(), share(F.col("vol") <= F.col("vol_now")))), 6).alias("vol_pctile"),
        F.round(pick("below", 1), 7).alias("drawdown"),
        F.round(F.avg(share(F.col("below") >= F.col("below_now"))), 6).alias("dd_pctile"),
        F.round(F.min("below"), 7).alias("max_drawdown"),
        F.round(pick("c", 1), 6).alias("market_corr"),
    )


@query(
    "factor_correlation",
    f"""WITH {DAILY}, u AS (SELECT date, series, value FROM d UNPIVOT (value FOR series IN (view, click, error, purchase, signup))), r AS (SELECT * FROM u WHERE date > (SELECT max(date) FROM u) - INTERVAL 730 DAY)
SELECT a.series AS a, b.series AS b, round(CASE WHEN var_pop(a.value) > 0 AND var_pop(b.value) > 0 THEN corr(a.value, b.value) END, 6) AS corr, count(*) AS n_days FROM r a JOIN r b USING (date) GROUP BY 1, 2""",
)
def factor_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of each two series over the last two years, on the days both have: all pairs from one wide row a day."""
    rows = daily(spark, sf_dir)
    last = rows.agg(F.max("date").alias("last"))
    recent = rows.join(F.broadcast(last), F.col("date") > F.date_sub("last", 730))  # one row
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for a in TENORS for b in TENORS]
    long = recent.select(F.inline(F.array(*pairs))).where("x is not null and y is not null")
    return long.groupBy("a", "b").agg(F.round(safe_corr(F.col("x"), F.col("y")), 6).alias("corr"), F.count("*").alias("n_days"))


@query(
    "rates_history",
    f"""WITH {DAILY}, u AS (SELECT date, series, value FROM d UNPIVOT (value FOR series IN (view, click, error, purchase, signup))) SELECT series, date, value FROM u WHERE date > (SELECT max(date) FROM d) - INTERVAL 30 DAY""",
)
def rates_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series over the last thirty days, one row a known value."""
    rows = daily(spark, sf_dir)
    last = rows.agg(F.max("date").alias("last"))
    recent = rows.join(F.broadcast(last), F.col("date") > F.date_sub("last", 30)).drop("last")  # one row
    return unpivot_known(recent, ["date"], TENORS, "series", "value")


@query(
    "fund_residuals",
    f"""WITH {RETS}, m AS (SELECT date, avg(ret) AS mkt FROM rets WHERE ret IS NOT NULL GROUP BY 1), p AS (
  SELECT key, date, ret, mkt, avg(ret) OVER w AS ma, avg(mkt) OVER w AS mm, covar_pop(ret, mkt) OVER w / nullif(var_pop(mkt) OVER w, 0) AS beta, count(*) OVER w AS n, month(date) = 12 AS pending FROM rets JOIN m USING (date) WHERE ret IS NOT NULL
  WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)), r AS (
  SELECT key, date, ret, beta * mkt AS market_part, ma - beta * mm AS alpha, ret - beta * mkt - (ma - beta * mm) AS resid, pending, row_number() OVER (PARTITION BY key ORDER BY date) AS k FROM p WHERE n >= 12 AND beta IS NOT NULL), o AS (
  SELECT *, CASE WHEN count(*) FILTER (WHERE NOT pending) OVER q >= 6 THEN sqrt(sum(CASE WHEN NOT pending THEN resid * resid * pow(0.5, -k / 15.0) END) OVER q / sum(CASE WHEN NOT pending THEN pow(0.5, -k / 15.0) END) OVER q) END AS sv FROM r
  WINDOW q AS (PARTITION BY key ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT key, date, round(alpha, 7) AS alpha, round(market_part, 7) AS market_part, round(resid, 7) AS resid, round(sv, 7) AS spec_vol, round(resid / nullif(sv, 0), 4) AS resid_z, pending FROM o""",
)
def fund_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns split by earlier loadings, with the residual's weighted volatility; pending rows have no weight in it."""
    rows = returns(spark, sf_dir).where("ret is not null").select("key", "date", "ret")
    rows = rows.join(rows.groupBy("date").agg(F.avg("ret").alias("mkt")), "date")
    past = trailing(by_key(), 24, 1)
    beta = F.try_divide(F.covar_pop("ret", "mkt").over(past), F.var_pop("mkt").over(past))
    rows = rows.select("*", beta.alias("beta"), F.avg("ret").over(past).alias("ma"), F.avg("mkt").over(past).alias("mm"), F.count("*").over(past).alias("n"))
    rows = rows.where("n >= 12 and beta is not null").withColumn("alpha", F.col("ma") - F.col("beta") * F.col("mm")).withColumn("market_part", F.col("beta") * F.col("mkt"))
    rows = rows.withColumn("resid", F.col("ret") - F.col("market_part") - F.col("alpha")).withColumn("pending", F.month("date") == 12)
    before = by_key().rowsBetween(Window.unboundedPreceding, -1)
    weight = F.when(~F.col("pending"), F.pow(F.lit(0.5), -F.row_number().over(by_key()) / 15.0))
    rows = rows.withColumn("weight", weight)
    sv = F.sqrt(F.try_divide(F.sum(F.col("weight") * F.col("resid") * F.col("resid")).over(before), F.sum("weight").over(before)))
    rows = rows.withColumn("sv", F.when(F.count("weight").over(before) >= 6, sv))
    return rows.select("key", "date", F.round("alpha", 7).alias("alpha"), F.round("market_part", 7).alias("market_part"), F.round("resid", 7).alias("resid"), F.round("sv", 7).alias("spec_vol"), F.round(F.try_divide("resid", "sv"), 4).alias("resid_z"), "pending")


@query(
    "borrow_board",
    """WITH s AS (SELECT l_suppkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, avg(l_discount) AS fee, sum(l_quantity) AS available FROM lineitem GROUP BY 1, 2), b AS (
  SELECT *, lag(fee, 5) OVER w AS fee_5, lag(available, 5) OVER w AS available_5 FROM s WINDOW w AS (PARTITION BY key ORDER BY date))
SELECT b.key, b.date, s_name AS name, round(fee, 7) AS fee, round(fee_5, 7) AS fee_5, round(least(available, 500), 2) AS available, available > 500 AS capped, round(available_5, 2) AS available_5 FROM b JOIN supplier ON s_suppkey = b.key WHERE b.date = (SELECT max(date) FROM b)""",
)
def borrow_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest snapshot of fees and availability beside the fifth before it."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("key"), F.trunc("l_shipdate", "month").alias("date")).agg(F.avg("l_discount").alias("fee"), F.sum("l_quantity").alias("available"))
    w = ordered(["key"], "date")
    rows = lines.withColumn("fee_5", F.lag("fee", 5).over(w)).withColumn("available_5", F.lag("available", 5).over(w))
    rows = rows.join(F.broadcast(lines.agg(F.max("date").alias("date"))), "date")  # one row
    rows = rows.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), "key")
    return rows.select("key", "date", "name", F.round("fee", 7).alias("fee"), F.round("fee_5", 7).alias("fee_5"), F.round(F.least("available", F.lit(500)), 2).alias("available"), (F.col("available") > 500).alias("capped"), F.round("available_5", 2).alias("available_5"))


@query(
    "row_value_in",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '5-LOW'))",
)
def row_value_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose two columns together are in a list of pairs."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return rows.where("(o_orderstatus, o_orderpriority) in (('F', '1-URGENT'), ('O', '5-LOW'))")


@query("columns_by_pattern", "SELECT COLUMNS('^l_(orderkey|linenumber|.*date)$') FROM lineitem")
def columns_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns whose names match a pattern; others never leave the scan."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(rows.colRegex("`^l_(orderkey|linenumber|.*date)$`"))


@query(
    "semi_join_on_ranges",
    f"""WITH {RETS}, falls AS (SELECT key, date FROM rets WHERE ret <= -0.3) SELECT key, date, round(ret, 7) AS ret FROM rets r WHERE EXISTS (SELECT 1 FROM falls f WHERE f.key = r.key AND f.date < r.date AND f.date >= r.date - INTERVAL 120 DAY)""",
)
def semi_join_on_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a fall of their key in the 120 days before: a semi join on a key and a range."""
    rows = returns(spark, sf_dir).select("key", "date", "ret")
    falls = rows.where("ret <= -0.3").select(F.col("key").alias("k"), F.col("date").alias("on"))
    near = (F.col("k") == F.col("key")) & (F.col("on") < F.col("date")) & (F.col("on") >= F.date_sub("date", 120))
    return rows.join(falls, near, "left_semi").select("key", "date", F.round("ret", 7).alias("ret"))


@query(
    "lists_overlap",
    """WITH o AS (SELECT l_orderkey AS orderkey, list_sort(list_distinct(list(l_returnflag))) AS flags FROM lineitem GROUP BY 1)
SELECT orderkey, array_to_string(flags, '|') AS flags, list_position(flags, 'N') AS place, list_has_any(flags, ['A', 'R']) AS settled FROM o WHERE list_contains(flags, 'N')""",
)
def lists_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of each order as a sorted list: where one stands in it, and whether any of several is there."""
    orders = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.sort_array(F.collect_set("l_returnflag")).alias("flags"))
    settled = F.arrays_overlap("flags", F.array(F.lit("A"), F.lit("R")))
    return orders.where(F.array_contains("flags", "N")).select("orderkey", F.array_join("flags", "|").alias("flags"), F.array_position("flags", "N").cast("int").alias("place"), settled.alias("settled"))


@query(
    "largest_above_floors",
    """WITH s AS (SELECT c_mktsegment AS segment, c_custkey AS key, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2), f AS (SELECT * FROM (VALUES (100000.0), (500000.0), (1000000.0)) t(floor)), r AS (
  SELECT floor, segment, key, total, row_number() OVER (PARTITION BY floor, segment ORDER BY total, key) AS place FROM s JOIN f ON total >= floor)
SELECT CAST(floor AS DOUBLE) AS floor, segment, key, total, CAST(place AS INT) AS place FROM r WHERE place <= 5""",
)
def largest_above_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five smallest totals that reach each of three floors, by segment: each row goes to the floors it reaches."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    rows = orders.join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment")), "key")
    floors = F.array(*[F.lit(x) for x in (100000.0, 500000.0, 1000000.0)])
    rows = rows.withColumn("floor", F.explode(floors)).where("total >= floor")
    place = F.row_number().over(Window.partitionBy("floor", "segment").orderBy("total", "key"))
    return rows.withColumn("place", place).where("place <= 5").select("floor", "segment", "key", "total", "place")
