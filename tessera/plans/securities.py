"""Identity, adjustment and trading costs: events, episodes, carried factors, lines, spreads, residual signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import asof_join, span_join
from ..operators.windows import enough, island, newest, ordered, trailing
from .factors import RESID, residuals
from .panel import PANEL, RETS, panel, returns, table
from .registry import query


def by_key():
    return ordered(["key"], "date")


ACTIONS = """acts AS (SELECT o_custkey % 150 AS key, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, CASE WHEN o_orderkey % 9 <> 0 THEN round(0.9 + (o_orderkey % 10) / 100.0, 4) END AS factor,
  o_totalprice AS cash, o_orderpriority = '1-URGENT' AS special FROM orders WHERE o_orderkey % 4 = 0)"""


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up events of a key and month; some factors are unknown."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0")
    factor = F.when(F.col("o_orderkey") % 9 != 0, F.round(0.9 + (F.col("o_orderkey") % 10) / 100, 4))
    return orders.select((F.col("o_custkey") % 150).alias("key"), F.trunc("o_orderdate", "month").alias("day"), factor.alias("factor"), F.col("o_totalprice").alias("cash"), (F.col("o_orderpriority") == "1-URGENT").alias("special"))


COLLAPSED = f"""{ACTIONS}, col AS (SELECT key, day, CASE WHEN count(factor) = count(*) THEN min(factor) END AS factor, coalesce(sum(cash) FILTER (WHERE NOT special), 0) AS regular_cash, sum(cash) AS cash, count(*) > 1 AS collapsed FROM acts GROUP BY 1, 2)"""


def collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event date: an unknown factor makes the event's factor unknown, special cash is left out of regular cash."""
    known = F.when(F.count("factor") == F.count("*"), F.min("factor"))
    regular = F.coalesce(F.sum(F.when(~F.col("special"), F.col("cash"))), F.lit(0.0))
    return actions(spark, sf_dir).groupBy("key", "day").agg(known.alias("factor"), regular.alias("regular_cash"), F.sum("cash").alias("cash"), (F.count("*") > 1).alias("collapsed"))


@query(
    "corporate_actions",
    f"WITH {COLLAPSED} SELECT key, day, factor, round(regular_cash, 2) AS regular_cash, round(cash, 2) AS cash, collapsed, bool_or(collapsed) OVER (PARTITION BY key ORDER BY day DESC) AS collapsed_at_or_after FROM col",
)
def corporate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = Window.partitionBy("key").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    rows = collapsed(spark, sf_dir)
    return rows.select("key", "day", "factor", F.round("regular_cash", 2).alias("regular_cash"), F.round("cash", 2).alias("cash"), "collapsed", F.bool_or("collapsed").over(later).alias("collapsed_at_or_after"))


@query(
    "cumulative_adjustment",
    f"""WITH {PANEL}, {COLLAPSED}, cum AS (SELECT key, day, lag(day) OVER a AS prev_day, exp(sum(ln(factor)) OVER b) AS later, count(*) OVER b = count(factor) OVER b AS known FROM col
  WINDOW a AS (PARTITION BY key ORDER BY day), b AS (PARTITION BY key ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT p.key, p.date, CASE WHEN c.key IS NULL THEN p.close WHEN c.known THEN round(p.close * c.later, 8) END AS adjusted FROM panel p LEFT JOIN cum c ON c.key = p.key AND p.date < c.day AND (c.prev_day IS NULL OR p.date >= c.prev_day)""",
)
def cumulative_adjustment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices times the product of all later factors: 1 without a later event, unknown if one of them is.

    The products are running sums of logs over the few events of a key; each spans the sessions up to its event.
    """
    after = ordered(["key"], "day").rowsBetween(0, Window.unboundedFollowing)
    events = collapsed(spark, sf_dir).select(
        "key",
        F.coalesce(F.lag("day").over(ordered(["key"], "day")), F.lit("0001-01-01").cast("date")).alias("start"),
        F.exp(F.sum(F.ln("factor")).over(after)).alias("later"),
        (F.count("*").over(after) == F.count("factor").over(after)).alias("known"),
        F.col("day").alias("until"),
    )
    joined = span_join(panel(spark, sf_dir).select("key", "date", "close"), events, ["key"], "date", "start")
    inside = F.coalesce(F.col("date") < F.col("until"), F.lit(False))
    adjusted = F.when(~inside, F.col("close")).when(F.col("known"), F.round(F.col("close") * F.col("later"), 8))
    return joined.select("key", "date", adjusted.alias("adjusted"))


@query(
    "ticker_change_carry",
    f"""WITH RECURSIVE {PANEL}, links AS (SELECT key AS old, key + 3 AS new, max(date) AS last FROM panel WHERE key % 3 <> 0 AND key <= 60 GROUP BY 1), f AS (SELECT key, 0.9 + (key % 5) / 50.0 AS factor FROM (SELECT DISTINCT key FROM panel) x), walk AS (
  SELECT f.key, l.new AS next, CAST(1.0 AS DOUBLE) AS carry, 0 AS steps FROM f LEFT JOIN links l ON l.old = f.key
  UNION ALL SELECT w.key, l.new, w.carry * f.factor, w.steps + 1 FROM walk w JOIN f ON f.key = w.next LEFT JOIN links l ON l.old = w.next)
SELECT key, round(arg_max(carry, steps), 9) AS carry, CAST(max(steps) AS BIGINT) AS steps FROM walk GROUP BY 1""",
)
def ticker_change_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product of factors along each key's chain of later names, by pointer doubling: log2 of the longest chain joins."""
    keys = panel(spark, sf_dir).select("key").distinct()
    there = keys.select(F.col("key").alias("next"))
    hop = keys.select("key", F.when((F.col("key") % 3 != 0) & (F.col("key") <= 60), F.col("key") + 3).alias("next"))
    hop = hop.join(there, "next", "left_semi").select("key", "next").withColumn("carry", 0.9 + (F.col("next") % 5) / 50).withColumn("steps", F.lit(1).cast("long"))
    for _ in range(5):  # chains of up to 32 names, as 60 keys in steps of 3 have 20 at most
        far = hop.select(F.col("key").alias("next"), F.col("next").alias("further"), F.col("carry").alias("more"), F.col("steps").alias("on"))
        joined = hop.join(far, "next", "left")
        hop = joined.select("key", F.coalesce("further", "next").alias("next"), (F.col("carry") * F.coalesce("more", F.lit(1.0))).alias("carry"), (F.col("steps") + F.coalesce("on", F.lit(0))).alias("steps"))
    return keys.join(hop, "key", "left").select("key", F.round(F.coalesce("carry", F.lit(1.0)), 9).alias("carry"), F.coalesce("steps", F.lit(0)).alias("steps"))


EPISODES = """rows AS (SELECT l_partkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CASE WHEN count(*) > 1 THEN min(l_returnflag) END AS figi, max(l_linestatus) AS word FROM lineitem GROUP BY 1, 2), near AS (
  SELECT *, lag(figi) OVER w AS before, lead(figi) OVER w AS after FROM rows WINDOW w AS (PARTITION BY ticker ORDER BY date)), flip AS (
  SELECT ticker, date, word, CASE WHEN before = after AND figi <> before THEN before ELSE figi END AS figi FROM near), known AS (
  SELECT *, last_value(figi IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_figi, lag(word) OVER (PARTITION BY ticker ORDER BY date) AS last_word FROM flip), runs AS (
  SELECT *, sum(CASE WHEN (figi IS NOT NULL AND last_figi IS NOT NULL AND figi <> last_figi) OR (figi IS NULL AND word <> last_word) THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS episode FROM known), filled AS (
  SELECT ticker, date, CAST(episode AS BIGINT) AS episode, max(figi) OVER (PARTITION BY ticker, episode) AS figi FROM runs)"""


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a ticker in episodes: one-session flips of the identifier are smoothed, an episode starts with another
    identifier, or another name word while there is none, and the identifier fills its episode."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("ticker"), F.trunc("l_shipdate", "month").alias("date"))
    rows = lines.agg(F.when(F.count("*") > 1, F.min("l_returnflag")).alias("figi"), F.max("l_linestatus").alias("word"))
    w = ordered(["ticker"], "date")
    before, after = F.lag("figi").over(w), F.lead("figi").over(w)
    rows = rows.select("ticker", "date", "word", F.when((before == after) & (F.col("figi") != before), before).otherwise(F.col("figi")).alias("figi"))
    last = F.last("figi", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    changed = F.when(F.col("figi").isNull(), F.col("word") != F.lag("word").over(w)).otherwise(F.col("figi") != last)
    rows = rows.withColumn("changed", F.coalesce(changed, F.lit(False))).withColumn("episode", island(F.col("changed"), w))
    return rows.withColumn("figi", F.max("figi").over(Window.partitionBy("ticker", "episode"))).select("ticker", "date", "episode", "figi")


@query("ticker_episodes", f"WITH {EPISODES} SELECT ticker, date, episode, figi FROM filled")
def ticker_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes(spark, sf_dir)


@query(
    "key_changes",
    f"""WITH {EPISODES}, spans AS (SELECT ticker, episode, any_value(figi) AS figi, min(date) AS first_date, max(date) AS last_date, count(*) AS n FROM filled GROUP BY 1, 2), l AS (
  SELECT *, lag(figi) OVER w AS old_figi, lag(last_date) OVER w AS old_last, lag(n) OVER w AS old_n FROM spans WINDOW w AS (PARTITION BY ticker ORDER BY first_date))
SELECT ticker, first_date, old_figi, figi, datediff('day', old_last, first_date) AS gap_days, old_n >= 3 AS old_seasoned, coalesce(old_figi = figi, false) AS same_figi FROM l WHERE old_last IS NOT NULL""",
)
def key_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change of episode with the tests on both sides; a null test fails."""
    spans = episodes(spark, sf_dir).groupBy("ticker", "episode").agg(F.first("figi").alias("figi"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n"))
    w = ordered(["ticker"], "first_date")
    rows = spans.withColumn("old_figi", F.lag("figi").over(w)).withColumn("old_last", F.lag("last_date").over(w)).withColumn("old_n", F.lag("n").over(w)).where("old_last is not null")
    gap = F.datediff("first_date", "old_last").cast("long")
    return rows.select("ticker", "first_date", "old_figi", "figi", gap.alias("gap_days"), (F.col("old_n") >= 3).alias("old_seasoned"), F.coalesce(F.col("old_figi") == F.col("figi"), F.lit(False)).alias("same_figi"))


@query(
    "primary_line",
    """WITH v AS (SELECT p_brand AS security, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_partkey AS ticker, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3), r AS (
  SELECT *, row_number() OVER (PARTITION BY security, date ORDER BY length(CAST(ticker AS VARCHAR)), value DESC, ticker) AS place FROM v) SELECT security, date, ticker, value FROM r WHERE place = 1""",
)
def primary_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per security and session: the shortest symbol, then the largest value."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    values = lines.groupBy(F.col("p_brand").alias("security"), F.trunc("l_shipdate", "month").alias("date"), F.col("l_partkey").alias("ticker")).agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))
    return newest(values, ["security", "date"], F.length(F.col("ticker").cast("string")), F.desc("value"), F.asc("ticker")).select("security", "date", "ticker", "value")


@query(
    "two_key_asof",
    """WITH b AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'error'), a1 AS (SELECT user_id, ts AS t1, max(value) AS v1 FROM events WHERE event_type = 'signup' GROUP BY 1, 2), a2 AS (SELECT user_id % 10 AS g, ts AS t2, max(value) AS v2 FROM events WHERE event_type = 'click' GROUP BY 1, 2), j1 AS (
  SELECT b.*, t1, v1 FROM b ASOF LEFT JOIN a1 ON b.user_id = a1.user_id AND b.ts >= a1.t1), j2 AS (SELECT j1.*, t2, v2 FROM j1 ASOF LEFT JOIN a2 ON j1.user_id % 10 = a2.g AND j1.ts >= a2.t2)
SELECT event_id, coalesce(CASE WHEN date_diff('day', t1::DATE, ts::DATE) <= 10 THEN v1 END, v2) AS mapped FROM j2""",
)
def two_key_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped by the finer key if that match is at most ten days old, else by the coarser one."""
    events = table(spark, sf_dir, "events")
    base = events.where("event_type = 'error'").select("event_id", "user_id", "ts", (F.col("user_id") % 10).alias("g"))
    fine = events.where("event_type = 'signup'").groupBy("user_id", F.col("ts").alias("t1")).agg(F.max("value").alias("v1"))
    coarse = events.where("event_type = 'click'").groupBy((F.col("user_id") % 10).alias("g"), F.col("ts").alias("t2")).agg(F.max("value").alias("v2"))
    found = asof_join(base, fine, "ts", "t1", ["user_id"], tolerance=10)
    found = asof_join(found, coarse, "ts", "t2", ["g"])
    return found.select("event_id", F.coalesce("v1", "v2").alias("mapped"))


SPREADS = f"""{RETS}, s AS (SELECT key, date, close, sqrt(avg(ret * ret) OVER w) AS sigma, avg(dollar_volume) OVER w AS adv, count(ret) OVER w AS n FROM rets WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING))"""


@query(
    "spreads",
    f"WITH {SPREADS} SELECT key, date, CASE WHEN n >= 12 THEN round(greatest(2 * 0.000821 * (sigma / 0.02) * pow(sigma * adv / 8e5, -1.0 / 3), 0.01 / close), 9) END AS spread FROM s",
)
def spreads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread by the invariance of trading, at least one tick; windows end the session before."""
    w = trailing(by_key(), 21, 1)
    sigma, adv = F.sqrt(F.avg(F.col("ret") * F.col("ret")).over(w)), F.avg("dollar_volume").over(w)
    model = 2 * 0.000821 * (sigma / 0.02) * F.pow(sigma * adv / 8e5, F.lit(-1.0 / 3))
    spread = F.greatest(model, 0.01 / F.col("close"))
    return returns(spark, sf_dir).select("key", "date", enough(F.round(spread, 9), F.count("ret").over(w), 12).alias("spread"))


@query(
    "close_range_spread",
    f"""WITH {RETS}, e AS (SELECT key, date, ln(close) AS c, (ln(close * 1.02) + ln(close * 0.97)) / 2 AS eta FROM rets), p AS (SELECT *, (c - eta) * (c - lead(eta) OVER (PARTITION BY key ORDER BY date)) AS x FROM e)
SELECT key, date, round(sqrt(greatest(4 * avg(x) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING), 0)), 7) AS spread FROM p""",
)
def close_range_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread from closes and the middle of the range, here of a fixed width."""
    c = F.ln("close")
    rows = returns(spark, sf_dir).select("key", "date", c.alias("c"), ((F.ln(F.col("close") * 1.02) + F.ln(F.col("close") * 0.97)) / 2).alias("eta"))
    rows = rows.withColumn("x", (F.col("c") - F.col("eta")) * (F.col("c") - F.lead("eta").over(by_key())))
    return rows.select("key", "date", F.round(F.sqrt(F.greatest(4 * F.avg("x").over(trailing(by_key(), 21, 1)), F.lit(0.0))), 7).alias("spread"))


@query(
    "residual_signals",
    f"""WITH {RESID}, s AS (SELECT *, CAST(year(date) * 12 + month(date) AS BIGINT) AS session FROM resid), w AS (
  SELECT *, session - min(session) OVER x3 = 2 AS whole_3, session - min(session) OVER x6 = 5 AS whole_6, sum(resid) OVER x3 AS s3, sum(resid) OVER x6 AS s6 FROM s
  WINDOW x3 AS (PARTITION BY key ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), x6 AS (PARTITION BY key ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
SELECT key, date, CASE WHEN whole_3 THEN round(-s3, 7) END AS reversal_3, CASE WHEN whole_6 THEN round(-s6, 7) END AS reversal_6 FROM w""",
)
def residual_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minus the sum of recent residuals, only where the rows are consecutive sessions."""
    rows = residuals(spark, sf_dir).withColumn("session", (F.year("date") * 12 + F.month("date")).cast("long"))

    def summed(k: int):
        w = trailing(by_key(), k)
        return F.when(F.col("session") - F.min("session").over(w) == k - 1, F.round(-F.sum("resid").over(w), 7))

    return rows.select("key", "date", summed(3).alias("reversal_3"), summed(6).alias("reversal_6"))


@query(
    "forward_residuals",
    f"""WITH {RESID} SELECT key, date, CASE WHEN count(resid) OVER w = 3 THEN round(sum(resid) OVER w, 7) END AS fwd_3 FROM resid WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)""",
)
def forward_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sum of the next three residuals, whole windows only."""
    w = by_key().rowsBetween(1, 3)
    return residuals(spark, sf_dir).select("key", "date", F.when(F.count("resid").over(w) == 3, F.round(F.sum("resid").over(w), 7)).alias("fwd_3"))


@query(
    "session_gap_returns",
    f"""WITH {PANEL.replace("l_suppkey", "l_partkey")}, c AS (SELECT date, lag(date) OVER (ORDER BY date) AS before FROM (SELECT DISTINCT date FROM panel) d), l AS (SELECT key, date, close, lag(date) OVER w AS pd, lag(close) OVER w AS pc FROM panel WINDOW w AS (PARTITION BY key ORDER BY date))
SELECT key, l.date, CASE WHEN pd = before THEN round(close / pc - 1, 9) END AS ret FROM l JOIN c USING (date)""",
)
def session_gap_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns that are null unless the key's previous row is the previous session."""
    rows, w = panel(spark, sf_dir, "l_partkey"), by_key()
    calendar = rows.select("date").distinct().withColumn("before", F.lag("date").over(Window.orderBy("date")))  # one row a session
    rows = rows.select("key", "date", "close", F.lag("date").over(w).alias("pd"), F.lag("close").over(w).alias("pc"))
    return rows.join(F.broadcast(calendar), "date").select("key", "date", F.when(F.col("pd") == F.col("before"), F.round(F.col("close") / F.col("pc") - 1, 9)).alias("ret"))


@query(
    "duplicate_events",
    "SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_extendedprice) > 1 AS disagree FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with several rows, and whether these disagree."""
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return grouped.agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("parts"), (F.countDistinct("l_extendedprice") > 1).alias("disagree")).where("n > 1")
