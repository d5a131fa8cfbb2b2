"""Signals, labels, information coefficients, portfolios and costs on the supplier panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalar import month_number, normal_p
from ..operators.reshape import unpivot_known
from ..operators.windows import average_rank, bucket, enough, ordered, safe_corr, trailing
from ..operators.windows import rolling_corr as rolling_corr_over
from .panel import PANEL, RETS, panel, returns, table
from .registry import query

def by_key() -> WindowSpec:
    """A key's rows by date."""
    return ordered(["key"], "date")


SIGNALS = ["reversal_1", "reversal_5", "momentum", "vol_20", "amihud_20", "high_52"]

SIGNALS_SQL = f"""{RETS}, signals AS (
  SELECT key, date, i, close, dollar_volume, ret,
    -ret AS reversal_1,
    round(-(close / lag(close, 5) OVER w - 1), 8) AS reversal_5,
    round(lag(close, 1) OVER w / lag(close, 12) OVER w - 1, 8) AS momentum,
    CASE WHEN count(ret) OVER w20 >= 20 THEN round(stddev_samp(ret) OVER w20, 8) END AS vol_20,
    CASE WHEN count(ret) OVER w20 >= 20 THEN round(avg(abs(ret) / dollar_volume) OVER w20 * 1e6, 8) END AS amihud_20,
    round(close / max(close) OVER w52, 8) AS high_52,
    round(lead(close, 1) OVER w / close - 1, 8) AS fwd_1,
    round(lead(close, 5) OVER w / close - 1, 8) AS fwd_5
  FROM rets
  WINDOW w AS (PARTITION BY key ORDER BY date),
    w20 AS (PARTITION BY key ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    w52 AS (PARTITION BY key ORDER BY date ROWS BETWEEN 51 PRECEDING AND CURRENT ROW))"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characteristics known at each session and the labels that follow it, from one window ordering."""
    w20, w52 = trailing(by_key(), 20), trailing(by_key(), 52)
    seen = F.count("ret").over(w20)
    rows = returns(spark, sf_dir)

    def back(n: int):
        return F.lag("close", n).over(by_key())

    return rows.select(
        "key",
        "date",
        "i",
        "close",
        "dollar_volume",
        "ret",
        (-F.col("ret")).alias("reversal_1"),
        F.round(-(F.col("close") / back(5) - 1), 8).alias("reversal_5"),
        F.round(back(1) / back(12) - 1, 8).alias("momentum"),
        enough(F.round(F.stddev_samp("ret").over(w20), 8), seen, 20).alias("vol_20"),
        enough(F.round(F.avg(F.abs("ret") / F.col("dollar_volume")).over(w20) * 1e6, 8), seen, 20).alias("amihud_20"),
        F.round(F.col("close") / F.max("close").over(w52), 8).alias("high_52"),
        F.round(F.lead("close", 1).over(by_key()) / F.col("close") - 1, 8).alias("fwd_1"),
        F.round(F.lead("close", 5).over(by_key()) / F.col("close") - 1, 8).alias("fwd_5"),
    )


@query("panel_signals", f"WITH {SIGNALS_SQL} SELECT key, date, reversal_1, reversal_5, momentum, vol_20, amihud_20, high_52 FROM signals")
def panel_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("key", "date", *SIGNALS)


@query("forward_returns", f"WITH {SIGNALS_SQL} SELECT key, date, fwd_1, fwd_5 FROM signals WHERE fwd_1 IS NOT NULL")
def forward_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("key", "date", "fwd_1", "fwd_5").where("fwd_1 is not null")


LONG_SQL = f"""{SIGNALS_SQL}, long AS (
  SELECT date, key, signal, value, fwd_1 FROM (SELECT date, key, fwd_1, reversal_1, reversal_5, momentum, vol_20, amihud_20, high_52 FROM signals) u
  UNPIVOT (value FOR signal IN (reversal_1, reversal_5, momentum, vol_20, amihud_20, high_52))), ranked AS (
  SELECT *, (rank() OVER (PARTITION BY signal, date ORDER BY value) + count(*) OVER (PARTITION BY signal, date ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2.0 AS avg_rank,
         count(*) OVER (PARTITION BY signal, date) AS n FROM long), placed AS (
  SELECT *, CAST(ceil(avg_rank * 5 / n) AS INT) AS quintile FROM ranked)"""


def ranked_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long panel: one row per signal, session and key with a known value, its average rank and quintile."""
    wide = signals(spark, sf_dir).select("date", "key", "fwd_1", *SIGNALS)
    long = unpivot_known(wide, ["date", "key", "fwd_1"], SIGNALS, "signal", "value")
    group = Window.partitionBy("signal", "date")
    rows = long.withColumn("avg_rank", average_rank(["signal", "date"], "value")).withColumn("n", F.count("*").over(group))
    return rows.withColumn("quintile", bucket(F.col("avg_rank"), F.col("n"), 5))


@query("signal_panel", f"WITH {LONG_SQL} SELECT signal, date, key, value, avg_rank, n, quintile FROM placed")
def signal_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_panel(spark, sf_dir).select("signal", "date", "key", "value", "avg_rank", "n", "quintile")


IC_SQL = f"""{LONG_SQL}, labelled AS (
  SELECT signal, date,
    (rank() OVER v + count(*) OVER (PARTITION BY signal, date ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2.0 AS rv,
    (rank() OVER l + count(*) OVER (PARTITION BY signal, date ORDER BY fwd_1 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2.0 AS rl
  FROM long WHERE fwd_1 IS NOT NULL
  WINDOW v AS (PARTITION BY signal, date ORDER BY value), l AS (PARTITION BY signal, date ORDER BY fwd_1)), ics AS (
  SELECT signal, date, count(*) AS n, round(CASE WHEN stddev_samp(rv) > 0 AND stddev_samp(rl) > 0 THEN corr(rv, rl) END, 6) AS ic
  FROM labelled GROUP BY 1, 2 HAVING count(*) >= 3)"""


def daily_ic(spark: SparkSession, sf_dir: str, least: int = 3) -> DataFrame:
    """Rank correlation of each signal with the next return across keys, per session."""
    rows = ranked_panel(spark, sf_dir).where("fwd_1 is not null")
    rows = rows.select("signal", "date", average_rank(["signal", "date"], "value").alias("rv"), average_rank(["signal", "date"], "fwd_1").alias("rl"))
    both = rows.groupBy("signal", "date").agg(F.count("*").alias("n"), F.round(safe_corr(F.col("rv"), F.col("rl")), 6).alias("ic"))
    return both.where(F.col("n") >= least)


@query("avg_rank_ic", f"WITH {IC_SQL} SELECT signal, date, n, ic FROM ics")
def avg_rank_ic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_ic(spark, sf_dir)


@query(
    "newey_west_t",
    f"""WITH {IC_SQL}, d AS (
  SELECT signal, date, ic - avg(ic) OVER (PARTITION BY signal) AS d, count(*) OVER (PARTITION BY signal) AS n, avg(ic) OVER (PARTITION BY signal) AS mean
  FROM ics WHERE ic IS NOT NULL), lags AS (
  SELECT signal, n, mean, d * d AS g0,
    d * lag(d, 1) OVER w AS g1, d * lag(d, 2) OVER w AS g2, d * lag(d, 3) OVER w AS g3, d * lag(d, 4) OVER w AS g4, d * lag(d, 5) OVER w AS g5
  FROM d WINDOW w AS (PARTITION BY signal ORDER BY date)), s AS (
  SELECT signal, any_value(n) AS n, any_value(mean) AS mean,
    (sum(g0) + 2 * (coalesce(sum(g1), 0) * 5 / 6 + coalesce(sum(g2), 0) * 4 / 6 + coalesce(sum(g3), 0) * 3 / 6 + coalesce(sum(g4), 0) * 2 / 6 + coalesce(sum(g5), 0) * 1 / 6)) / any_value(n) AS var
  FROM lags GROUP BY signal)
SELECT signal, n AS n_days, round(mean, 6) AS mean_ic, round(sqrt(greatest(var, 0) / n), 6) AS se, round(mean / nullif(sqrt(greatest(var, 0) / n), 0), 4) AS t_nw FROM s""",
)
def newey_west_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean IC with Newey-West errors: Bartlett weights over 5 lags as sums of lagged self-products."""
    lag = 5
    own, order = Window.partitionBy("signal"), Window.partitionBy("signal").orderBy("date")
    rows = daily_ic(spark, sf_dir).where("ic is not null")
    rows = rows.select("signal", "date", F.avg("ic").over(own).alias("mean"), (F.col("ic") - F.avg("ic").over(own)).alias("d"))
    rows = rows.select("signal", "mean", (F.col("d") * F.col("d")).alias("g0"), *[(F.col("d") * F.lag("d", k).over(order)).alias(f"g{k}") for k in range(1, lag + 1)])
    n, mean = F.count("g0"), F.first("mean")
    weighted = sum((F.coalesce(F.sum(f"g{k}"), F.lit(0.0)) * (2.0 * (lag + 1 - k) / (lag + 1)) for k in range(1, lag + 1)), F.sum("g0"))
    sums = rows.groupBy("signal").agg(n.alias("n_days"), mean.alias("mean"), (weighted / n).alias("var"))
    se = F.sqrt(F.greatest("var", F.lit(0.0)) / F.col("n_days"))
    return sums.select("signal", "n_days", F.round("mean", 6).alias("mean_ic"), F.round(se, 6).alias("se"), F.round(F.try_divide(F.col("mean"), se), 4).alias("t_nw"))


@query(
    "quintile_long_short",
    f"""WITH {LONG_SQL}, sides AS (
  SELECT *, min(quintile) OVER (PARTITION BY signal, date) AS low, max(quintile) OVER (PARTITION BY signal, date) AS high FROM placed WHERE fwd_1 IS NOT NULL)
SELECT signal, date, round(avg(fwd_1) FILTER (WHERE quintile = high) - avg(fwd_1) FILTER (WHERE quintile = low), 6) AS spread, count(*) AS n
FROM sides GROUP BY 1, 2 HAVING any_value(low) < any_value(high)""",
)
def quintile_long_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean label of the highest quintile that has names, less that of the lowest."""
    group = Window.partitionBy("signal", "date")
    rows = ranked_panel(spark, sf_dir).where("fwd_1 is not null")
    rows = rows.withColumn("low", F.min("quintile").over(group)).withColumn("high", F.max("quintile").over(group)).where("low < high")
    side = lambda c: F.avg(F.when(F.col("quintile") == F.col(c), F.col("fwd_1")))
    return rows.groupBy("signal", "date").agg(F.round(side("high") - side("low"), 6).alias("spread"), F.count("*").alias("n"))


@query(
    "quintile_means",
    f"WITH {LONG_SQL} SELECT signal, quintile, count(*) AS n, round(avg(fwd_1), 7) AS mean_fwd FROM placed WHERE fwd_1 IS NOT NULL GROUP BY 1, 2",
)
def quintile_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranked_panel(spark, sf_dir).where("fwd_1 is not null")
    return rows.groupBy("signal", "quintile").agg(F.count("*").alias("n"), F.round(F.avg("fwd_1"), 7).alias("mean_fwd"))


TOP_SQL = f"""{LONG_SQL}, sessions AS (SELECT signal, date, dense_rank() OVER (PARTITION BY signal ORDER BY date) AS s FROM (SELECT DISTINCT signal, date FROM placed) t), top AS (
  SELECT p.signal, p.date, p.key, x.s FROM placed p JOIN sessions x USING (signal, date) WHERE quintile = 5)"""


def top_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the top quintile with the number of their session."""
    rows = ranked_panel(spark, sf_dir)
    rows = rows.withColumn("s", F.dense_rank().over(Window.partitionBy("signal").orderBy("date")).cast("long"))
    return rows.where("quintile = 5").select("signal", "date", "key", "s")


@query(
    "turnover",
    f"""WITH {TOP_SQL}, moved AS (
  SELECT c.signal, c.date, avg(CASE WHEN p.key IS NULL THEN 1.0 ELSE 0.0 END) AS share
  FROM top c LEFT JOIN top p ON p.signal = c.signal AND p.key = c.key AND p.s = c.s - 1 WHERE c.s > 1 GROUP BY 1, 2)
SELECT signal, count(*) AS n_days, round(avg(share), 6) AS turnover FROM moved GROUP BY 1""",
)
def turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean share of top-quintile members that were not members at the previous session."""
    top = top_members(spark, sf_dir)
    before = top.select("signal", "key", (F.col("s") + 1).alias("s"), F.lit(1).alias("was"))
    daily = top.where("s > 1").join(before, ["signal", "key", "s"], "left").groupBy("signal", "date").agg(F.avg(F.when(F.col("was").isNull(), 1.0).otherwise(0.0)).alias("share"))
    return daily.groupBy("signal").agg(F.count("*").alias("n_days"), F.round(F.avg("share"), 6).alias("turnover"))


@query(
    "full_outer_leg_moves",
    f"""WITH {TOP_SQL}, moves AS (
  SELECT coalesce(c.signal, p.signal) AS signal, coalesce(c.s, p.s + 1) AS s, count(*) FILTER (WHERE p.key IS NULL) AS entered, count(*) FILTER (WHERE c.key IS NULL) AS gone
  FROM top c FULL JOIN top p ON p.signal = c.signal AND p.key = c.key AND p.s = c.s - 1 GROUP BY 1, 2)
SELECT signal, CAST(s AS BIGINT) AS s, entered, gone FROM moves""",
)
def full_outer_leg_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many members enter and leave each signal's top leg, by a full join with the leg of the session before."""
    top = top_members(spark, sf_dir).select("signal", "key", "s").withColumn("now", F.lit(1))
    before = top.select("signal", "key", (F.col("s") + 1).alias("s"), F.lit(1).alias("was"))
    both = top.join(before, ["signal", "key", "s"], "full")
    return both.groupBy("signal", "s").agg(F.count_if(F.col("was").isNull()).alias("entered"), F.count_if(F.col("now").isNull()).alias("gone"))


@query(
    "costs_capacity",
    f"""WITH {LONG_SQL}, adv AS (
  SELECT key, date, avg(dollar_volume) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS adv FROM signals)
SELECT signal, date, count(*) AS n, round(quantile_cont(adv, 0.1), 4) AS p10, round(0.05 * count(*) * quantile_cont(adv, 0.1), 1) AS capacity
FROM placed JOIN adv USING (key, date) WHERE quintile = 5 AND adv IS NOT NULL GROUP BY 1, 2""",
)
def costs_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the top leg could hold: 5 % of the tenth percentile of its members' earlier dollar volume, times members."""
    adv = signals(spark, sf_dir).select("key", "date", F.avg("dollar_volume").over(trailing(by_key(), 6, 1)).alias("adv")).where("adv is not null")
    rows = ranked_panel(spark, sf_dir).where("quintile = 5").join(adv, ["key", "date"])
    tenth = F.percentile("adv", 0.1)
    return rows.groupBy("signal", "date").agg(F.count("*").alias("n"), F.round(tenth, 4).alias("p10"), F.round(0.05 * F.count("*") * tenth, 1).alias("capacity"))


@query(
    "rank_correlation_matrix",
    f"""WITH {LONG_SQL}, pairs AS (
  SELECT a.signal AS a, b.signal AS b, a.date, count(*) AS n, CASE WHEN stddev_samp(a.avg_rank) > 0 AND stddev_samp(b.avg_rank) > 0 THEN corr(a.avg_rank, b.avg_rank) END AS c
  FROM ranked a JOIN ranked b ON a.date = b.date AND a.key = b.key AND a.signal < b.signal GROUP BY 1, 2, 3 HAVING count(*) >= 3)
SELECT a, b, count(c) AS n_days, round(avg(c), 6) AS mean_corr FROM pairs GROUP BY 1, 2""",
)
def rank_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean daily rank correlation of each pair of signals: one wide row per name, all pairs in one aggregate."""
    rows = ranked_panel(spark, sf_dir).select("date", "key", "signal", "avg_rank")
    wide = rows.groupBy("date", "key").pivot("signal", sorted(SIGNALS)).agg(F.first("avg_rank"))
    names = sorted(SIGNALS)
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for i, a in enumerate(names) for b in names[i + 1 :]]
    long = wide.select("date", F.inline(F.array(*pairs))).where("x is not null and y is not null")
    daily = long.groupBy("a", "b", "date").agg(F.count("*").alias("n"), safe_corr(F.col("x"), F.col("y")).alias("c")).where("n >= 3")
    return daily.groupBy("a", "b").agg(F.count("c").alias("n_days"), F.round(F.avg("c"), 6).alias("mean_corr"))


@query(
    "signal_snapshot",
    f"""WITH {LONG_SQL}, last AS (SELECT * FROM ranked WHERE date = (SELECT max(date) FROM panel))
SELECT signal, key, value, round((value - avg(value) OVER (PARTITION BY signal)) / nullif(stddev_samp(value) OVER (PARTITION BY signal), 0), 5) AS z, CAST(ceil(avg_rank * 10 / n) AS INT) AS decile FROM last""",
)
def signal_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranked_panel(spark, sf_dir)
    last = panel(spark, sf_dir).agg(F.max("date").alias("date"))
    rows = rows.join(F.broadcast(last), "date")  # one row
    own = Window.partitionBy("signal")
    z = F.try_divide(F.col("value") - F.avg("value").over(own), F.stddev_samp("value").over(own))
    return rows.select("signal", "key", "value", F.round(z, 5).alias("z"), bucket(F.col("avg_rank"), F.col("n"), 10).alias("decile"))


@query(
    "beta_window",
    f"""WITH {RETS}, mkt AS (
  SELECT date, sum(ret * dollar_volume) / sum(dollar_volume) AS mkt FROM rets WHERE ret IS NOT NULL GROUP BY 1), paired AS (
  SELECT key, date, ret, mkt FROM rets JOIN mkt USING (date))
SELECT key, date, round(CASE WHEN count(ret) OVER w >= 12 THEN covar_pop(ret, mkt) OVER w / nullif(var_pop(mkt) OVER w, 0) END, 6) AS beta FROM paired
WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
)
def beta_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beta to the volume-weighted market over 24 rows, null below 12 pairs."""
    rows = returns(spark, sf_dir)
    known = rows.where("ret is not null")
    mkt = known.groupBy("date").agg((F.sum(F.col("ret") * F.col("dollar_volume")) / F.sum("dollar_volume")).alias("mkt"))
    both, w = rows.join(mkt, "date"), trailing(by_key(), 24)
    beta = F.try_divide(F.covar_pop("ret", "mkt").over(w), F.var_pop("mkt").over(w))
    return both.select("key", "date", F.round(enough(beta, F.count("ret").over(w), 12), 6).alias("beta"))


@query(
    "eval_folds",
    f"""WITH {PANEL}, s AS (SELECT date, row_number() OVER (ORDER BY date) AS session, ntile(10) OVER (ORDER BY date) AS ten FROM (SELECT DISTINCT date FROM panel) t), f AS (
  SELECT date, session, CASE WHEN ten >= 9 THEN 5 ELSE (ten + 1) // 2 END AS fold FROM s)
SELECT date, CAST(session AS BIGINT) AS session, CAST(fold AS BIGINT) AS fold, CAST(lead(fold, 5) OVER (ORDER BY date) AS BIGINT) AS label_fold,
  coalesce(fold = lead(fold, 5) OVER (ORDER BY date), false) AS usable FROM f""",
)
def eval_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions dealt to four development folds and a holdout; a session is usable if its label ends in its own fold."""
    order = Window.orderBy("date")  # one row a session
    dates = panel(spark, sf_dir).select("date").distinct()
    ten = F.ntile(10).over(order)
    rows = dates.select("date", F.row_number().over(order).cast("long").alias("session"), F.when(ten >= 9, 5).otherwise(F.floor((ten + 1) / 2)).cast("long").alias("fold"))
    rows = rows.withColumn("label_fold", F.lead("fold", 5).over(order))
    return rows.withColumn("usable", F.coalesce(F.col("fold") == F.col("label_fold"), F.lit(False)))


@query(
    "event_window_study",
    f"""WITH {RETS}, stats AS (SELECT key, avg(ret) AS m, stddev_samp(ret) AS s FROM rets GROUP BY 1), ev AS (
  SELECT r.key, r.i AS i0 FROM rets r JOIN stats USING (key) WHERE abs(ret - m) >= 2 * s), path AS (
  SELECT e.key, e.i0, r.i - e.i0 AS day, r.ret FROM ev e JOIN rets r ON r.key = e.key AND r.i BETWEEN e.i0 - 2 AND e.i0 + 3)
SELECT day, count(*) AS n, round(avg(ret), 7) AS mean, round(stddev_samp(ret), 7) AS sd FROM path WHERE ret IS NOT NULL GROUP BY 1""",
)
def event_window_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean return around shocks of two deviations, from 2 rows before to 3 after; each event joins its window by row number."""
    rows = returns(spark, sf_dir)
    own = Window.partitionBy("key")
    shocks = rows.withColumn("gap", F.abs(F.col("ret") - F.avg("ret").over(own)) - 2 * F.stddev_samp("ret").over(own)).where("gap >= 0")
    days = shocks.select("key", "i", F.explode(F.sequence(F.lit(-2), F.lit(3))).alias("day"))
    path = days.withColumn("i", F.col("i") + F.col("day")).join(rows.select("key", "i", "ret"), ["key", "i"]).where("ret is not null")
    return path.groupBy(F.col("day").cast("long").alias("day")).agg(F.count("*").alias("n"), F.round(F.avg("ret"), 7).alias("mean"), F.round(F.stddev_samp("ret"), 7).alias("sd"))


@query(
    "seasonality_bh",
    f"""WITH {RETS}, m AS (SELECT date, avg(ret) AS ret FROM rets WHERE ret IS NOT NULL GROUP BY 1), e AS (
  SELECT month(date) AS bucket, count(*) AS n, avg(ret) AS mean, stddev_samp(ret) AS sd FROM m GROUP BY 1), t AS (
  SELECT bucket, n, mean, mean / nullif(sd / sqrt(n), 0) AS t FROM e), z AS (SELECT *, abs(t) / sqrt(2) AS z, 1 / (1 + 0.5 * abs(t) / sqrt(2)) AS k FROM t), p AS (
  SELECT *, least(1.0, k * exp(-z * z - 1.26551223 + k * (1.00002368 + k * (0.37409196 + k * (0.09678418 + k * (-0.18628806 + k * (0.27886807 + k * (-1.13520398 + k * (1.48851587 + k * (-0.82215223 + k * 0.17087277)))))))))) AS p FROM z), r AS (
  SELECT *, row_number() OVER (ORDER BY p, bucket) AS place, count(p) OVER () AS tests FROM p), l AS (SELECT max(p) AS limit_p FROM r WHERE p <= place * 0.05 / tests)
SELECT CAST(bucket AS INT) AS bucket, n, round(mean, 7) AS mean, round(t, 5) AS t, round(p, 6) AS p, coalesce(p <= limit_p, false) AS significant FROM r, l""",
)
def seasonality_bh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month effects of the mean return with normal p-values and the Benjamini-Hochberg limit at 5 %."""
    market = returns(spark, sf_dir).where("ret is not null").groupBy("date").agg(F.avg("ret").alias("ret"))
    effects = market.groupBy(F.month("date").alias("bucket")).agg(F.count("*").alias("n"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("sd"))
    effects = effects.withColumn("t", F.try_divide(F.col("mean"), F.col("sd") / F.sqrt("n"))).withColumn("p", normal_p(F.col("t")))
    all_rows = Window.partitionBy()  # twelve rows at most
    ranked = effects.withColumn("place", F.row_number().over(Window.orderBy(F.col("p").asc_nulls_last(), "bucket"))).withColumn("tests", F.count("p").over(all_rows))
    limit = F.max(F.when(F.col("p") <= F.col("place") * 0.05 / F.col("tests"), F.col("p"))).over(all_rows)
    return ranked.select("bucket", "n", F.round("mean", 7).alias("mean"), F.round("t", 5).alias("t"), F.round("p", 6).alias("p"), F.coalesce(F.col("p") <= limit, F.lit(False)).alias("significant"))


@query(
    "rolling_corr",
    f"""WITH {RETS}, mkt AS (SELECT date, avg(ret) AS mkt FROM rets WHERE ret IS NOT NULL GROUP BY 1), paired AS (SELECT key, date, ret, mkt FROM rets JOIN mkt USING (date))
SELECT key, date, round(CASE WHEN count(ret) OVER w >= 12 AND stddev_samp(ret) OVER w > 0 AND stddev_samp(mkt) OVER w > 0 THEN corr(ret, mkt) OVER w END, 6) AS c FROM paired
WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)""",
)
def rolling_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir)
    mkt = rows.where("ret is not null").groupBy("date").agg(F.avg("ret").alias("mkt"))
    w = trailing(by_key(), 21)
    return rows.join(mkt, "date").select("key", "date", F.round(rolling_corr_over("mkt", "ret", w, 12), 6).alias("c"))


@query(
    "range_frame_months",
    """WITH m AS (SELECT p_brand AS brand, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_extendedprice) AS v FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2), n AS (
  SELECT *, year(month) * 12 + month(month) AS mn FROM m WHERE (year(month) * 12 + month(month) + length(brand)) % 7 <> 0), r AS (
  SELECT brand, month, mn, CASE WHEN max(mn) OVER (PARTITION BY brand ORDER BY mn RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) IS NOT NULL THEN round(v / max(v) OVER (PARTITION BY brand ORDER BY mn RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) - 1, 9) END AS ret FROM n)
SELECT brand, month, ret, CASE WHEN count(ret) OVER w >= 8 THEN round(avg(ret) OVER w, 7) END AS mom, max(ret) OVER (PARTITION BY brand ORDER BY mn RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS next_ret FROM r
WINDOW w AS (PARTITION BY brand ORDER BY mn RANGE BETWEEN 11 PRECEDING AND 1 PRECEDING)""",
)
def range_frame_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows on month numbers, so a missing month is missing and not skipped."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    rows = lines.groupBy(F.col("p_brand").alias("brand"), F.trunc("l_shipdate", "month").alias("month")).agg(F.sum("l_extendedprice").alias("v"))
    rows = rows.withColumn("mn", month_number(F.col("month"))).where((F.col("mn") + F.length("brand")) % 7 != 0)
    w = Window.partitionBy("brand").orderBy("mn")
    rows = rows.withColumn("ret", F.round(F.col("v") / F.max("v").over(w.rangeBetween(-1, -1)) - 1, 9))
    past = w.rangeBetween(-11, -1)
    return rows.select("brand", "month", "ret", enough(F.round(F.avg("ret").over(past), 7), F.count("ret").over(past), 8).alias("mom"), F.max("ret").over(w.rangeBetween(1, 1)).alias("next_ret"))
