"""Monitor marts: rates and their percentiles, curve moves, relations, regimes, short interest, flows, calendars, movers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranges import at_least
from ..operators.reshape import unpivot_known
from ..operators.windows import newest, ordered, rolling_corr, top_k
from .panel import PANEL, RETS, panel, returns, table
from .registry import query

TENORS = ["view", "click", "error", "purchase", "signup"]

DAILY = """d AS (SELECT CAST(ts AS DATE) AS date, round(avg(value) FILTER (WHERE event_type = 'view'), 9) AS view, round(avg(value) FILTER (WHERE event_type = 'click'), 9) AS click, round(avg(value) FILTER (WHERE event_type = 'error'), 9) AS error,
  round(avg(value) FILTER (WHERE event_type = 'purchase'), 9) AS purchase, round(avg(value) FILTER (WHERE event_type = 'signup'), 9) AS signup FROM events GROUP BY 1)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a day, one column a series."""
    events = table(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    return events.groupBy("date").pivot("event_type", TENORS).agg(F.round(F.avg("value"), 9))


@query(
    "derived_rates",
    f"WITH {DAILY} SELECT date, round(view - click, 6) AS slope, round(2 * click - view - error, 6) AS fly, round(2 * purchase - signup, 6) AS forward, round(coalesce(view, click) / 100 * datediff('day', lag(date) OVER (ORDER BY date), date) / 360, 9) AS carry FROM d",
)
def derived_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope, butterfly, forward and the day's carry; one row a day, so one window."""
    days = F.datediff("date", F.lag("date").over(Window.orderBy("date")))
    c = F.col
    return daily(spark, sf_dir).select(
        "date",
        F.round(c("view") - c("click"), 6).alias("slope"),
        F.round(2 * c("click") - c("view") - c("error"), 6).alias("fly"),
        F.round(2 * c("purchase") - c("signup"), 6).alias("forward"),
        F.round(F.coalesce("view", "click") / 100 * days / 360, 9).alias("carry"),
    )


@query(
    "rates_board",
    f"""WITH {DAILY}, u AS (SELECT date, series, value FROM d UNPIVOT (value FOR series IN (view, click, error, purchase, signup))), l AS (
  SELECT *, value - lag(value, 1) OVER w AS change_1, value - lag(value, 5) OVER w AS change_5, percent_rank() OVER (PARTITION BY series ORDER BY value) AS p, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM u WINDOW w AS (PARTITION BY series ORDER BY date))
SELECT series, date, round(value, 6) AS value, round(change_1, 6) AS change_1, round(change_5, 6) AS change_5, round(p, 7) AS pctile FROM l WHERE back = 1""",
)
def rates_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each series' last value, its changes and where it stands in its history."""
    rows = unpivot_known(daily(spark, sf_dir), ["date"], TENORS, "series", "value")
    w = ordered(["series"], "date")
    rows = rows.withColumn("change_1", F.col("value") - F.lag("value", 1).over(w)).withColumn("change_5", F.col("value") - F.lag("value", 5).over(w))
    rows = rows.withColumn("p", F.percent_rank().over(ordered(["series"], "value")))
    last = newest(rows, ["series"], F.desc("date"))
    return last.select("series", "date", F.round("value", 6).alias("value"), F.round("change_1", 6).alias("change_1"), F.round("change_5", 6).alias("change_5"), F.round("p", 7).alias("pctile"))


@query("curve_pca")
def curve_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eigenvectors of the covariance of daily changes of five series: (component, series, loading, share).

    The covariance is five by five and comes from one aggregate; signs are fixed by the largest loading.
    """
    w = Window.orderBy("date")  # one row a day
    moves = daily(spark, sf_dir).select(*[(F.col(t) - F.lag(t).over(w)).alias(t) for t in TENORS]).dropna()
    cells = [F.covar_samp(a, b).alias(f"{a}_{b}") for a in TENORS for b in TENORS]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                value, vector = np.linalg.eigh(np.array(row, float).reshape(len(TENORS), -1))
                out = []
                for j in range(3):
                    v = vector[:, -1 - j]
                    v = v * np.sign(v[np.abs(v).argmax()])
                    out += [(j, t, float(x), float(value[-1 - j] / value.sum())) for t, x in zip(TENORS, v)]
                yield pd.DataFrame(out, columns=["component", "series", "loading", "share"])

    found = moves.agg(*cells).mapInPandas(solve, "component int, series string, loading double, share double")
    return found.select("component", "series", F.round("loading", 7).alias("loading"), F.round("share", 7).alias("share"))


@query(
    "curve_factors",
    f"""WITH {DAILY}, m AS (SELECT date, (view + click + error) / 3 - lag((view + click + error) / 3) OVER (ORDER BY date) AS level, (view - error) - lag(view - error) OVER (ORDER BY date) AS slope FROM d), z AS (
  SELECT date, level, slope, stddev_samp(level) OVER w AS sl, stddev_samp(slope) OVER w AS ss, count(level) OVER w AS n FROM m WINDOW w AS (ORDER BY date ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING))
SELECT date, round(level, 7) AS level, round(slope, 7) AS slope, CASE WHEN n >= 5 THEN round(level / nullif(sl, 0), 5) END AS level_z, CASE WHEN n >= 5 THEN round(slope / nullif(ss, 0), 5) END AS slope_z FROM z""",
)
def curve_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.orderBy("date")  # one row a day
    before = w.rowsBetween(-15, -1)
    level, slope = (F.col("view") + F.col("click") + F.col("error")) / 3, F.col("view") - F.col("error")
    moves = daily(spark, sf_dir).select("date", (level - F.lag(level).over(w)).alias("level"), (slope - F.lag(slope).over(w)).alias("slope"))
    seen = F.count("level").over(before)
    z = lambda c: F.when(seen >= 5, F.round(F.try_divide(F.col(c), F.stddev_samp(c).over(before)), 5))
    return moves.select("date", F.round("level", 7).alias("level"), F.round("slope", 7).alias("slope"), z("level").alias("level_z"), z("slope").alias("slope_z"))


@query(
    "relations",
    f"""WITH {DAILY}, x AS (SELECT date, view / nullif(click, 0) AS ratio, view, error FROM d), v AS (
  SELECT date, ratio, ratio / first_value(ratio) OVER w * 100 AS rebased, ratio / lag(ratio, 5) OVER w - 1 AS change_5, CASE WHEN count(view) OVER c >= 8 THEN corr(view, error) OVER c END AS corr_10, percent_rank() OVER (ORDER BY ratio NULLS LAST) AS p FROM x
  WINDOW w AS (ORDER BY date), c AS (ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT date, round(rebased, 6) AS rebased, round(change_5, 7) AS change_5, round(corr_10, 6) AS corr_10, round(p, 7) AS pctile FROM v""",
)
def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratio of two series rebased to 100, its change and percentile, and a trailing correlation."""
    w = Window.orderBy("date")  # one row a day
    rows = daily(spark, sf_dir).withColumn("ratio", F.try_divide("view", "click"))
    return rows.select(
        "date",
        F.round(F.col("ratio") / F.first("ratio").over(w) * 100, 6).alias("rebased"),
        F.round(F.col("ratio") / F.lag("ratio", 5).over(w) - 1, 7).alias("change_5"),
        F.round(rolling_corr("view", "error", w.rowsBetween(-9, 0), 8), 6).alias("corr_10"),
        F.round(F.percent_rank().over(Window.orderBy(F.col("ratio").asc_nulls_last())), 7).alias("pctile"),
    )


@query(
    "market_regime",
    f"""WITH {RETS}, m AS (SELECT date, avg(ret) AS mean, stddev_samp(ret) AS dispersion, sum(dollar_volume) AS turnover FROM rets WHERE ret IS NOT NULL GROUP BY 1), u AS (SELECT date, measure, value FROM m UNPIVOT (value FOR measure IN (mean, dispersion, turnover))), last AS (
  SELECT measure, arg_max(value, date) AS value, avg(value) AS avg, stddev_samp(value) AS sd, count(*) AS n FROM u GROUP BY 1)
SELECT l.measure, l.n, round((l.value - l.avg) / nullif(l.sd, 0), 5) AS z, round(avg(CASE WHEN u.value <= l.value THEN 1.0 ELSE 0.0 END), 6) AS share_below FROM last l JOIN u USING (measure) GROUP BY l.measure, l.n, l.value, l.avg, l.sd""",
)
def market_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the last value of each measure stands in its own history."""
    rows = returns(spark, sf_dir).where("ret is not null").groupBy("date")
    wide = rows.agg(F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("dispersion"), F.sum("dollar_volume").alias("turnover"))
    long = unpivot_known(wide, ["date"], ["mean", "dispersion", "turnover"], "measure", "value")
    last = long.groupBy("measure").agg(F.max_by("value", "date").alias("last"), F.avg("value").alias("avg"), F.stddev_samp("value").alias("sd"), F.count("*").alias("n"))
    both = long.join(F.broadcast(last), "measure").groupBy("measure", "n")  # one row a measure, of which there is a fixed list
    z = F.try_divide(F.first("last") - F.first("avg"), F.first("sd"))
    return both.agg(F.round(z, 5).alias("z"), F.round(F.avg(F.when(F.col("value") <= F.col("last"), 1.0).otherwise(0.0)), 6).alias("share_below"))


@query(
    "short_interest_board",
    """WITH s AS (SELECT l_suppkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS settled, sum(l_quantity) AS si, sum(l_quantity) / count(*) AS adv FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), c AS (
  SELECT key, settled, si, CASE WHEN si / adv < 12 THEN si / adv END AS days, lag(si) OVER w AS prev, lag(settled) OVER w AS prev_settled FROM s WINDOW w AS (PARTITION BY key ORDER BY settled))
SELECT key, settled, round(si, 2) AS si, round(days, 6) AS days, CASE WHEN datediff('day', prev_settled, settled) <= 35 THEN round(ln(si / prev), 7) END AS change FROM c""",
)
def short_interest_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settlements with a censored ratio as null, and changes only from a settlement at most 35 days before."""
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    rows = lines.groupBy(F.col("l_suppkey").alias("key"), F.trunc("l_shipdate", "month").alias("settled")).agg(F.sum("l_quantity").alias("si"), (F.sum("l_quantity") / F.count("*")).alias("adv"))
    w = ordered(["key"], "settled")
    days = F.col("si") / F.col("adv")
    near = F.datediff("settled", F.lag("settled").over(w)) <= 35
    return rows.select("key", "settled", F.round("si", 2).alias("si"), F.when(days < 12, F.round(days, 6)).alias("days"), F.when(near, F.round(F.ln(F.col("si") / F.lag("si").over(w)), 7)).alias("change"))


@query(
    "short_interest_history",
    """WITH s AS (SELECT l_suppkey AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS settled, sum(l_quantity) AS si FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) SELECT settled, count(*) AS n, round(sum(si), 2) AS total, round(median(si), 4) AS middle FROM s GROUP BY 1""",
)
def short_interest_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    rows = lines.groupBy("l_suppkey", F.trunc("l_shipdate", "month").alias("settled")).agg(F.sum("l_quantity").alias("si"))
    return rows.groupBy("settled").agg(F.count("*").alias("n"), F.round(F.sum("si"), 2).alias("total"), F.round(F.median("si"), 4).alias("middle"))


@query(
    "flow_windows",
    f"""WITH {PANEL}, f AS (SELECT key, date, (volume - lag(volume) OVER w) * close AS flow, dollar_volume FROM panel WINDOW w AS (PARTITION BY key ORDER BY date))
SELECT key, date, round(flow, 3) AS flow_1, round(sum(flow) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 3) AS flow_5, round((flow - avg(flow) OVER p) / nullif(stddev_samp(flow) OVER p, 0), 5) AS z FROM f
WINDOW p AS (PARTITION BY key ORDER BY date ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
)
def flow_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ordered(["key"], "date")
    rows = panel(spark, sf_dir).select("key", "date", ((F.col("volume") - F.lag("volume").over(w)) * F.col("close")).alias("flow"))
    before = w.rowsBetween(-24, -1)
    z = F.try_divide(F.col("flow") - F.avg("flow").over(before), F.stddev_samp("flow").over(before))
    return rows.select("key", "date", F.round("flow", 3).alias("flow_1"), F.round(F.sum("flow").over(w.rowsBetween(-4, 0)), 3).alias("flow_5"), F.round(z, 5).alias("z"))


@query(
    "holders",
    """WITH v AS (SELECT l_partkey AS line, l_suppkey AS fund, sum(l_extendedprice) AS val FROM lineitem GROUP BY 1, 2), r AS (SELECT *, count(*) OVER (PARTITION BY line) AS funds, row_number() OVER (PARTITION BY line ORDER BY val DESC, fund) AS place FROM v)
SELECT line, fund, round(val, 2) AS val, funds FROM r WHERE place <= 5""",
)
def holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest holders of each line and how many there are."""
    value = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("line"), F.col("l_suppkey").alias("fund")).agg(F.sum("l_extendedprice").alias("val"))
    value = value.withColumn("funds", F.count("*").over(Window.partitionBy("line")))
    return top_k(value, ["line"], 5, F.desc("val"), F.asc("fund")).select("line", "fund", F.round("val", 2).alias("val"), "funds")


@query(
    "upcoming_calendar",
    """WITH n AS (SELECT CAST(max(ts) AS DATE) AS today FROM events), a AS (SELECT 'purchase' AS kind, event_id AS id, CAST(ts AS DATE) AS day, value AS size FROM events WHERE event_type = 'purchase' AND value > 90 UNION ALL BY NAME SELECT CAST(ts AS DATE) AS day, 'signup' AS kind, event_id AS id, CAST(NULL AS DOUBLE) AS size FROM events WHERE event_type = 'signup')
SELECT kind, id, day, size FROM a, n WHERE day > today - 7""",
)
def upcoming_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two kinds near the last day, united by name."""
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    today = events.agg(F.max("day").alias("today"))
    large = events.where("event_type = 'purchase' and value > 90").select(F.lit("purchase").alias("kind"), F.col("event_id").alias("id"), "day", F.col("value").alias("size"))
    new = events.where("event_type = 'signup'").select("day", F.lit("signup").alias("kind"), F.col("event_id").alias("id"))
    both = large.unionByName(new, allowMissingColumns=True)
    return both.join(F.broadcast(today), F.col("day") > F.date_sub("today", 7)).select("kind", "id", "day", "size")


@query(
    "movers_scored",
    f"""WITH {RETS}, pool AS (SELECT round(abs(ret), 6) AS a, count(*) AS c FROM rets WHERE ret IS NOT NULL GROUP BY 1), t AS (SELECT a, sum(c) OVER (ORDER BY a DESC) AS at_least, sum(c) OVER () AS n FROM pool), m AS (
  SELECT key, date, ret, row_number() OVER (PARTITION BY date ORDER BY abs(ret) DESC, key) AS place FROM rets WHERE ret IS NOT NULL), x AS (SELECT key, date, ret, round(abs(ret) * 0.9, 6) AS p FROM m WHERE place <= 3)
SELECT key, date, ret, CAST(coalesce(at_least, 0) AS BIGINT) AS at_least FROM x ASOF LEFT JOIN t ON x.p <= t.a""",
)
def movers_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest moves of a session with how many moves of the pool are as large, counted by ranges of size."""
    rows = returns(spark, sf_dir).where("ret is not null")
    top = top_k(rows, ["date"], 3, F.desc(F.abs("ret")), F.asc("key")).select("key", "date", "ret", F.round(F.abs("ret") * 0.9, 6).alias("p"))
    pool = rows.select(F.round(F.abs("ret"), 6).alias("p"), F.lit(1).alias("c")).unionByName(top.select("p", F.lit(0).alias("c")))
    found = top.join(at_least(pool, [], "p", F.col("c")), "p")
    return found.select("key", "date", "ret", F.coalesce("at_least", F.lit(0)).cast("long").alias("at_least"))
