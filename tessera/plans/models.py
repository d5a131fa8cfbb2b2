"""Whole models on stand-in tables: ticker episodes with their keys, sessions, fund masters and universes, line mapping, exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import as_printed, half_away
from ..operators.regress import standard_params, standardize_with
from ..operators.windows import filled, island, newest, ordered, trailing
from .evaluation import factor_risk
from .funds import INDEX, index_returns
from .monitor import DAILY, TENORS, daily
from .panel import PANEL, RETS, panel, returns, table
from .registry import ORACLE_SQL, query
from .research import by_key

REFERENCE = """ref AS (SELECT 'T' || l_partkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, max(l_linestatus) || CASE WHEN count(*) > 2 THEN ' Corp' ELSE ' Inc' END AS name, CASE WHEN count(*) % 4 <> 0 THEN min(l_returnflag) END AS type,
  CASE WHEN sum(l_linenumber) % 3 <> 0 THEN 'C' || (l_partkey % 7) || min(l_returnflag) END AS cik, CASE WHEN sum(l_linenumber) % 2 = 0 THEN 'B' || (l_partkey // 4) || max(l_returnflag) END AS cf, CASE WHEN count(*) > 1 THEN 'S' || (l_partkey // 4) || min(l_returnflag) END AS sc FROM lineitem GROUP BY l_partkey, 2)"""

KEYED = f"""{REFERENCE}, f AS (SELECT *, lag(date) OVER w IS NULL OR name IS DISTINCT FROM lag(name) OVER w OR cik IS DISTINCT FROM lag(cik) OVER w OR cf IS DISTINCT FROM lag(cf) OVER w OR sc IS DISTINCT FROM lag(sc) OVER w AS starts FROM ref WINDOW w AS (PARTITION BY ticker ORDER BY date)), n AS (
  SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY ticker ORDER BY date) AS run FROM f), runs AS (
  SELECT ticker, run, lower(regexp_extract(any_value(name), '[A-Za-z0-9]+')) AS word, any_value(cik) AS cik, any_value(cf) AS cf, any_value(sc) AS sc, count(*) AS n_rows FROM n GROUP BY 1, 2), near AS (
  SELECT *, last_value(sc IGNORE NULLS) OVER e AS sc0, first_value(sc IGNORE NULLS) OVER l AS sc1, last_value(cf IGNORE NULLS) OVER e AS cf0, first_value(cf IGNORE NULLS) OVER l AS cf1 FROM runs
  WINDOW e AS (PARTITION BY ticker ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), l AS (PARTITION BY ticker ORDER BY run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)), sm AS (
  SELECT ticker, run, word, cik, CASE WHEN n_rows = 1 AND sc <> sc0 AND sc0 = sc1 THEN sc0 ELSE sc END AS sc, CASE WHEN n_rows = 1 AND cf <> cf0 AND cf0 = cf1 THEN cf0 ELSE cf END AS cf FROM near), fl AS (
  SELECT *, coalesce(sc <> last_value(sc IGNORE NULLS) OVER e, false) OR coalesce(cf <> last_value(cf IGNORE NULLS) OVER e, false) OR coalesce(word <> last_value(word IGNORE NULLS) OVER e AND (cik IS NULL OR cik <> coalesce(last_value(cik IGNORE NULLS) OVER e, '')), false) AS starts FROM sm
  WINDOW e AS (PARTITION BY ticker ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), ep AS (SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY ticker ORDER BY run) AS episode FROM fl), fi AS (
  SELECT ticker, run, episode, sc, cf, first_value(sc IGNORE NULLS) OVER p AS esc, first_value(cf IGNORE NULLS) OVER p AS ecf, first_value(cik IGNORE NULLS) OVER p AS ecik FROM ep
  WINDOW p AS (PARTITION BY ticker, episode ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), g AS (
  SELECT n.ticker, n.date, n.type, CAST(fi.episode AS BIGINT) AS episode, fi.sc, fi.cf, ecik,
    CASE WHEN fi.sc IS NULL AND EXISTS (SELECT 1 FROM ref r WHERE r.date = n.date AND r.ticker <> n.ticker AND (r.sc = esc OR r.cf = esc)) THEN NULL ELSE esc END AS esc,
    CASE WHEN fi.cf IS NULL AND EXISTS (SELECT 1 FROM ref r WHERE r.date = n.date AND r.ticker <> n.ticker AND (r.sc = ecf OR r.cf = ecf)) THEN NULL ELSE ecf END AS ecf FROM n JOIN fi USING (ticker, run)), keyed AS (
  SELECT ticker, date, type, episode, coalesce(sc, esc, cf, ecf, ecik || '.' || ticker, 'TICKER.' || ticker) AS security_key,
    CASE WHEN sc IS NOT NULL THEN 'share_class' WHEN esc IS NOT NULL THEN 'share_class_filled' WHEN coalesce(cf, ecf) IS NOT NULL THEN 'composite' WHEN ecik IS NOT NULL THEN 'cik_ticker' ELSE 'ticker_only' END AS key_rule FROM g)"""


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ticker's name, type and identifiers by date, some of them missing."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("date"))
    rows = lines.agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("s"), F.max("l_linestatus").alias("status"), F.min("l_returnflag").alias("low"), F.max("l_returnflag").alias("high"))
    group = F.floor(F.col("l_partkey") / 4).cast("string")
    return rows.select(
        F.concat(F.lit("T"), "l_partkey").alias("ticker"),
        "date",
        F.concat("status", F.when(F.col("n") > 2, " Corp").otherwise(" Inc")).alias("name"),
        F.when(F.col("n") % 4 != 0, F.col("low")).alias("type"),
        F.when(F.col("s") % 3 != 0, F.concat(F.lit("C"), F.col("l_partkey") % 7, "low")).alias("cik"),
        F.when(F.col("s") % 2 == 0, F.concat(F.lit("B"), group, "high")).alias("cf"),
        F.when(F.col("n") > 1, F.concat(F.lit("S"), group, "low")).alias("sc"),
    )


def keyed_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ticker and date with its episode and security key.

    Rows of the same fields form runs. An identifier that one row states between two others of another value is
    smoothed. An episode ends when an identifier changes, or the name's first word does and the issuer is not the known
    one. An episode's identifiers fill its runs, unless another ticker states them on the date: an equi-join with the
    lowest and highest ticker that states an identifier finds that, so tickers never pair up.
    """
    rows = reference(spark, sf_dir)
    w = ordered(["ticker"], "date")
    fields = ["name", "cik", "cf", "sc"]
    changed = F.lag("date").over(w).isNull()
    for c in fields:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    rows = rows.withColumn("starts", changed).withColumn("run", island(F.col("starts"), w)).drop("starts")
    runs = rows.groupBy("ticker", "run", *fields).agg(F.count("*").alias("n_rows"))
    runs = runs.withColumn("word", F.lower(F.regexp_extract("name", "[A-Za-z0-9]+", 0)))
    order = ordered(["ticker"], "run")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    last = lambda c: F.last(c, ignorenulls=True).over(before)

    def smooth(c: str) -> Column:
        old = last(c)
        return F.when((F.col("n_rows") == 1) & (F.col(c) != old) & (old == F.first(c, ignorenulls=True).over(after)), old).otherwise(F.col(c)).alias(c)

    runs = runs.select("ticker", "run", "word", "cik", smooth("sc"), smooth("cf"))
    no = F.lit(False)
    issuer = F.col("cik").isNull() | (F.col("cik") != F.coalesce(last("cik"), F.lit("")))
    starts = F.coalesce(F.col("sc") != last("sc"), no) | F.coalesce(F.col("cf") != last("cf"), no) | F.coalesce((F.col("word") != last("word")) & issuer, no)
    runs = runs.withColumn("starts", starts).withColumn("episode", island(F.col("starts"), order))
    whole = Window.partitionBy("ticker", "episode").orderBy("run").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = [F.first(c, ignorenulls=True).over(whole).alias(f"e{c}") for c in ("sc", "cf", "cik")]
    dated = rows.select("ticker", "date", "type", "run").join(runs.select("ticker", "run", "episode", "sc", "cf", *known), ["ticker", "run"])
    stated = rows.select("date", "ticker", F.explode(F.array("sc", "cf")).alias("figi")).where("figi is not null")
    stated = stated.groupBy("date", "figi").agg(F.min("ticker").alias("low"), F.max("ticker").alias("high"))
    for c in ("sc", "cf"):
        own = stated.select("date", F.col("figi").alias(f"e{c}"), "low", "high")
        dated = dated.join(own, ["date", f"e{c}"], "left")
        elsewhere = F.coalesce((F.col("low") != F.col("ticker")) | (F.col("high") != F.col("ticker")), no)
        dated = dated.withColumn(f"e{c}", F.when(~(F.col(c).isNull() & elsewhere), F.col(f"e{c}"))).drop("low", "high")
    key = F.coalesce("sc", "esc", "cf", "ecf", F.concat("ecik", F.lit("."), "ticker"), F.concat(F.lit("TICKER."), "ticker"))
    rule = F.when(F.col("sc").isNotNull(), "share_class").when(F.col("esc").isNotNull(), "share_class_filled").when(F.coalesce("cf", "ecf").isNotNull(), "composite")
    rule = rule.when(F.col("ecik").isNotNull(), "cik_ticker").otherwise("ticker_only")
    return dated.select("ticker", "date", "type", F.col("episode").cast("long").alias("episode"), key.alias("security_key"), rule.alias("key_rule"))


@query("episode_keys", f"WITH {KEYED} SELECT ticker, date, episode, security_key, key_rule FROM keyed")
def episode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_tickers(spark, sf_dir).drop("type")


@query(
    "tickers_keyed",
    f"WITH {KEYED} SELECT ticker, date, security_key, coalesce(type, last_value(type IGNORE NULLS) OVER (PARTITION BY security_key ORDER BY date, length(ticker), ticker ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS type_filled FROM keyed",
)
def tickers_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing type is the last one that the security had."""
    w = Window.partitionBy("security_key").orderBy("date", F.length("ticker"), "ticker")
    return keyed_tickers(spark, sf_dir).select("ticker", "date", "security_key", filled("type", w).alias("type_filled"))


@query(
    "holdings_lines",
    f"""WITH {KEYED}, names AS (SELECT ticker, date, lower(regexp_extract(name, '[A-Za-z0-9]+')) AS word FROM ref), asked AS (
  SELECT l_suppkey AS fund, l_orderkey AS report, l_linenumber AS line, l_partkey, l_extendedprice AS val, CASE WHEN l_partkey % 3 = 0 THEN 'S' || (l_partkey // 4) || l_returnflag END AS figi, 'T' || l_partkey AS ticker, lower(l_linestatus) AS word FROM lineitem WHERE l_returnflag <> 'N'), k AS (SELECT DISTINCT security_key FROM keyed), t AS (
  SELECT ticker, word, security_key FROM (SELECT ticker, word, security_key, row_number() OVER (PARTITION BY ticker, word ORDER BY max(date) DESC, security_key) AS place FROM keyed JOIN names USING (ticker, date) GROUP BY 1, 2, 3) x WHERE place = 1)
SELECT fund, report, line, val, coalesce(k.security_key, t.security_key) AS security_key, CASE WHEN k.security_key IS NOT NULL THEN 'figi' WHEN t.security_key IS NOT NULL THEN 'ticker' END AS matched_on FROM asked a LEFT JOIN k ON k.security_key = a.figi LEFT JOIN t ON t.ticker = a.ticker AND t.word = a.word AND k.security_key IS NULL""",
)
def holdings_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines mapped to a security by identifier, else by ticker where the name's first word agrees on both sides."""
    keys = keyed_tickers(spark, sf_dir).select("ticker", "date", "security_key")
    names = reference(spark, sf_dir).select("ticker", "date", F.lower(F.regexp_extract("name", "[A-Za-z0-9]+", 0)).alias("word"))
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'")
    figi = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("S"), F.floor(F.col("l_partkey") / 4).cast("string"), "l_returnflag"))
    asked = lines.select(F.col("l_suppkey").alias("fund"), F.col("l_orderkey").alias("report"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("val"), figi.alias("figi"), F.concat(F.lit("T"), "l_partkey").alias("ticker"), F.lower("l_linestatus").alias("word"))
    by_figi = asked.join(keys.select(F.col("security_key").alias("figi"), F.col("security_key").alias("own")).distinct(), "figi", "left")
    spans = keys.join(names, ["ticker", "date"]).groupBy("ticker", "word", "security_key").agg(F.max("date").alias("last"))
    by_ticker = newest(spans, ["ticker", "word"], F.desc("last"), F.asc("security_key")).select("ticker", "word", F.col("security_key").alias("named"))
    both = by_figi.join(by_ticker, ["ticker", "word"], "left")
    matched = F.when(F.col("own").isNotNull(), "figi").when(F.col("named").isNotNull(), "ticker")
    return both.select("fund", "report", "line", "val", F.coalesce("own", "named").alias("security_key"), matched.alias("matched_on"))


@query(
    "security_sessions",
    f"""WITH {PANEL}, x AS (SELECT key, date, s_name AS name, n_name AS industry, close, volume, dollar_volume, avg(dollar_volume) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS adv FROM panel JOIN supplier ON s_suppkey = key JOIN nation ON n_nationkey = s_nationkey)
SELECT key, date, name, industry, close, volume, dollar_volume, round(adv, 4) AS adv, coalesce(adv >= 50000 AND close >= 1, false) AS in_universe FROM x""",
)
def security_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per security and session with prices, earlier volume and whether it is in the universe."""
    names = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("n_name").alias("industry"))
    rows = panel(spark, sf_dir).withColumn("adv", F.avg("dollar_volume").over(trailing(by_key(), 6, 1))).join(names, "key")
    inside = F.coalesce((F.col("adv") >= 50000) & (F.col("close") >= 1), F.lit(False))
    return rows.select("key", "date", "name", "industry", "close", "volume", "dollar_volume", F.round("adv", 4).alias("adv"), inside.alias("in_universe"))


@query(
    "borrow_lines",
    """WITH b AS (SELECT p_brand AS security, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CAST(l_partkey AS VARCHAR) AS ticker, CASE WHEN l_partkey % 3 = 0 THEN 'figi' ELSE 'ticker' END AS matched_on, round(avg(l_discount), 7) AS fee, round(sum(l_quantity), 2) AS available FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, l_partkey)
SELECT security, date, ticker, matched_on, fee, available FROM b QUALIFY row_number() OVER (PARTITION BY date, security ORDER BY matched_on = 'figi' DESC, length(ticker), ticker) = 1""",
)
def borrow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One borrow line per security and session: a match by identifier first, then the shorter ticker."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    rows = lines.groupBy(F.col("p_brand").alias("security"), F.trunc("l_shipdate", "month").alias("date"), "l_partkey").agg(F.round(F.avg("l_discount"), 7).alias("fee"), F.round(F.sum("l_quantity"), 2).alias("available"))
    rows = rows.withColumn("ticker", F.col("l_partkey").cast("string")).withColumn("matched_on", F.when(F.col("l_partkey") % 3 == 0, "figi").otherwise("ticker"))
    first = newest(rows, ["date", "security"], F.desc(F.col("matched_on") == "figi"), F.length("ticker"), F.asc("ticker"))
    return first.select("security", "date", "ticker", "matched_on", "fee", "available")


@query(
    "fund_master",
    """WITH pulls AS (SELECT p_brand AS fund, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS pulled, round(avg(l_discount), 7) AS expense, round(sum(l_extendedprice), 2) AS assets FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 1 GROUP BY 1, 2), latest AS (
  SELECT * FROM pulls QUALIFY row_number() OVER (PARTITION BY fund ORDER BY pulled DESC) = 1), series AS (SELECT p_brand AS fund, min(CAST(l_shipdate AS DATE)) AS first_date, max(CAST(l_shipdate AS DATE)) AS last_date, count(DISTINCT CAST(l_shipdate AS DATE)) AS n_days FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY 1)
SELECT l.fund, pulled, expense, assets, right(l.fund, 1) <> '5' AS holdings_tracked, first_date, last_date, n_days FROM latest l LEFT JOIN series USING (fund)""",
)
def fund_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fund's newest screener row, whether its holdings are tracked, and the span of its series."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("fund")), F.col("p_partkey") == F.col("l_partkey"))
    pulls = lines.where("l_linenumber = 1").groupBy("fund", F.trunc("l_shipdate", "quarter").alias("pulled")).agg(F.round(F.avg("l_discount"), 7).alias("expense"), F.round(F.sum("l_extendedprice"), 2).alias("assets"))
    latest = newest(pulls, ["fund"], F.desc("pulled"))
    day = F.col("l_shipdate").cast("date")
    series = lines.where("l_returnflag = 'R'").groupBy("fund").agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.countDistinct(day).alias("n_days"))
    return latest.withColumn("holdings_tracked", F.substring("fund", -1, 1) != "5").join(series, "fund", "left").select("fund", "pulled", "expense", "assets", "holdings_tracked", "first_date", "last_date", "n_days")


@query(
    "fund_universe",
    f"""WITH {INDEX}, b AS (SELECT idx, month, mn, ret, count(ret) OVER (PARTITION BY idx ORDER BY mn ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS n_returns, sqrt(avg(ret * ret) OVER (PARTITION BY idx ORDER BY mn ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)) AS sigma FROM r)
SELECT idx, month, round(ret, 8) AS ret, n_returns, round(sigma, 8) AS sigma, CASE WHEN sigma > 0 THEN round(greatest(0.000821 * (sigma / 0.02) * pow(sigma * 1e6 / 800000.0, -1.0 / 3), 0.005), 9) END AS half_spread, n_returns >= 10 AS eligible FROM b""",
)
def fund_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of each fund at each close: returns seen, recent size of moves, half a spread, and eligibility."""
    w = Window.partitionBy("idx").orderBy("mn")
    rows = index_returns(spark, sf_dir).withColumn("n_returns", F.count("ret").over(trailing(w, 12))).withColumn("sigma", F.sqrt(F.avg(F.col("ret") * F.col("ret")).over(trailing(w, 6))))
    model = 0.000821 * (F.col("sigma") / 0.02) * F.pow(F.col("sigma") * 1e6 / 800000.0, F.lit(-1.0 / 3))
    half = F.when(F.col("sigma") > 0, F.round(F.greatest(model, F.lit(0.005)), 9))
    return rows.select("idx", "month", F.round("ret", 8).alias("ret"), "n_returns", F.round("sigma", 8).alias("sigma"), half.alias("half_spread"), (F.col("n_returns") >= 10).alias("eligible"))


#: Percentiles this far from an end are unusual.
TAIL = 0.1


@query(
    "exceptions_board",
    f"""WITH risk AS ({ORACLE_SQL["factor_risk"]}), items AS (
  SELECT 'volatility' AS area, key, printf('%d volatility %.1f%% a year, above %.0f%% of its history', key, 100 * vol, 100 * vol_pctile) AS message, 2 + (vol_pctile - {1 - TAIL}) / {TAIL} AS score, -1 AS direction FROM risk WHERE vol_pctile >= {1 - TAIL} UNION ALL
  SELECT 'drawdown', key, printf('%d drawdown %.1f%%, deeper than %.0f%% of its history', key, 100 * drawdown, 100 * dd_pctile), 2 + (dd_pctile - {1 - TAIL}) / {TAIL}, -1 FROM risk WHERE dd_pctile >= {1 - TAIL} AND drawdown < -0.05 UNION ALL
  SELECT 'move', key, printf('%d %+.1f%% over three months', key, 100 * ret_3), 5 * abs(ret_3), CAST(sign(ret_3) AS INT) FROM risk WHERE abs(ret_3) >= 0.5 UNION ALL
  SELECT 'market', key, printf('%d correlation with the market %.2f', key, market_corr), 5 * abs(market_corr), CAST(sign(market_corr) AS INT) FROM risk WHERE abs(market_corr) >= 0.5)
SELECT area, key, message, round(score, 4) AS score, direction FROM items""",
)
def exceptions_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is unusual about each series' last row, one row an item: every rule looks at the same row, so one pass serves all."""
    risk = factor_risk(spark, sf_dir)
    c = F.col
    tail = lambda p: 2 + (c(p) - (1 - TAIL)) / TAIL

    def item(area: str, when: Column, text: Column, score: Column, direction: Column) -> Column:
        return F.when(when, F.struct(F.lit(area).alias("area"), text.alias("message"), half_away(score, 4).alias("score"), direction.cast("int").alias("direction")))

    items = [
        item("volatility", c("vol_pctile") >= 1 - TAIL, F.format_string("%d volatility %.1f%% a year, above %.0f%% of its history", "key", as_printed(100 * c("vol"), 1), as_printed(100 * c("vol_pctile"), 0)), tail("vol_pctile"), F.lit(-1)),
        item("drawdown", (c("dd_pctile") >= 1 - TAIL) & (c("drawdown") < -0.05), F.format_string("%d drawdown %.1f%%, deeper than %.0f%% of its history", "key", as_printed(100 * c("drawdown"), 1), as_printed(100 * c("dd_pctile"), 0)), tail("dd_pctile"), F.lit(-1)),
        item("move", F.abs("ret_3") >= 0.5, F.format_string("%d %+.1f%% over three months", "key", as_printed(100 * c("ret_3"), 1)), 5 * F.abs("ret_3"), F.signum("ret_3")),
        item("market", F.abs("market_corr") >= 0.5, F.format_string("%d correlation with the market %.2f", "key", as_printed(c("market_corr"), 2)), 5 * F.abs("market_corr"), F.signum("market_corr")),
    ]
    return risk.select("key", F.inline(F.array_compact(F.array(*items)))).select("area", "key", "message", "score", "direction")


@query(
    "coverage_exposures",
    f"""WITH {PANEL}, u AS (SELECT * FROM panel WHERE key % 4 <> 0), m AS (SELECT date, median(volume) AS med, count(volume) AS n FROM u GROUP BY 1), d AS (SELECT date, 1.4826 * median(abs(volume - med)) AS mad FROM u JOIN m USING (date) GROUP BY 1), l AS (
  SELECT date, n, CASE WHEN mad > 0 THEN med - 5 * mad ELSE -1e300 END AS lo, CASE WHEN mad > 0 THEN med + 5 * mad ELSE 1e300 END AS hi FROM m JOIN d USING (date)), p AS (
  SELECT date, any_value(n) AS n, any_value(lo) AS lo, any_value(hi) AS hi, sum(least(greatest(volume, lo), hi) * dollar_volume) / sum(dollar_volume) AS mu, stddev_pop(least(greatest(volume, lo), hi)) AS sd FROM u JOIN l USING (date) GROUP BY 1)
SELECT c.key, c.date, round(CASE WHEN n >= 3 AND sd > 0 THEN least(greatest((least(greatest(volume, lo), hi) - mu) / sd, -3), 3) ELSE 0 END, 6) AS z FROM panel c JOIN p USING (date) WHERE c.key % 4 = 0""",
)
def coverage_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names outside the estimation universe, standardized with the universe's parameters of the session."""
    rows = panel(spark, sf_dir)
    params = standard_params(rows.where("key % 4 <> 0"), ["date"], "volume", "dollar_volume")
    scored = standardize_with(rows.where("key % 4 = 0"), params, ["date"], "volume", "z", how="inner")
    return scored.select("key", "date", F.round("z", 6).alias("z"))


@query(
    "coverage_residuals",
    f"""WITH {RETS}, x AS (SELECT key, date, ret, dollar_volume, ln(dollar_volume) AS size FROM rets WHERE ret IS NOT NULL), f AS (
  SELECT date, count(*) AS n, regr_slope(ret, size) AS b, regr_intercept(ret, size) AS a FROM x WHERE key % 4 <> 0 GROUP BY 1), r AS (
  SELECT x.key, x.date, x.ret, a AS market_part, b * size AS style_part, x.ret - a - b * size AS resid FROM x JOIN f USING (date) WHERE key % 4 = 0 AND n >= 5 AND b IS NOT NULL)
SELECT key, date, round(ret, 7) AS ret, round(market_part, 6) AS market_part, round(style_part, 6) AS style_part, round(resid, 6) AS resid, round(CASE WHEN count(resid) OVER w >= 6 THEN stddev_samp(resid) OVER w END, 6) AS spec_vol FROM r
WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def coverage_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns of covered names less what the universe's cross-section of the session explains, and their earlier spread."""
    rows = returns(spark, sf_dir).where("ret is not null").withColumn("size", F.ln("dollar_volume"))
    fits = rows.where("key % 4 <> 0").groupBy("date").agg(F.count("*").alias("n"), F.regr_slope("ret", "size").alias("b"), F.regr_intercept("ret", "size").alias("a")).where("n >= 5 and b is not null")
    own = rows.where("key % 4 = 0").join(fits, "date").select("key", "date", "ret", F.col("a").alias("market_part"), (F.col("b") * F.col("size")).alias("style_part"))
    own = own.withColumn("resid", F.col("ret") - F.col("market_part") - F.col("style_part"))
    before = by_key().rowsBetween(Window.unboundedPreceding, -1)
    vol = F.when(F.count("resid").over(before) >= 6, F.stddev_samp("resid").over(before))
    return own.select("key", "date", F.round("ret", 7).alias("ret"), F.round("market_part", 6).alias("market_part"), F.round("style_part", 6).alias("style_part"), F.round("resid", 6).alias("resid"), F.round(vol, 6).alias("spec_vol"))


@query(
    "macro_factors",
    f"""WITH {DAILY}, l AS (SELECT date, view - lag(view) OVER w AS view, click - lag(click) OVER w AS click, error - lag(error) OVER w AS error, purchase - lag(purchase) OVER w AS purchase, signup - lag(signup) OVER w AS signup FROM d WINDOW w AS (ORDER BY date))
SELECT date, round(view, 7) AS view, round(click, 7) AS click, round(error, 7) AS error, round(purchase, 7) AS purchase, round(signup, 7) AS signup,
  concat_ws('|', CASE WHEN view IS NULL THEN 'view' END, CASE WHEN click IS NULL THEN 'click' END, CASE WHEN error IS NULL THEN 'error' END, CASE WHEN purchase IS NULL THEN 'purchase' END, CASE WHEN signup IS NULL THEN 'signup' END) AS pending FROM l""",
)
def macro_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily changes of each series, and which of them are not observed yet; one row a day, so one window."""
    w = Window.orderBy("date")
    rows = daily(spark, sf_dir).select("date", *[(F.col(c) - F.lag(c).over(w)).alias(c) for c in TENORS])
    pending = F.concat_ws("|", *[F.when(F.col(c).isNull(), F.lit(c)) for c in TENORS])
    return rows.select("date", *[F.round(c, 7).alias(c) for c in TENORS], pending.alias("pending"))


@query(
    "search_names",
    """WITH n AS (SELECT s_suppkey AS key, s_name AS name, CASE WHEN CAST(s_suppkey AS VARCHAR) = '7' THEN 0 WHEN lower(s_name) = '7' THEN 1 WHEN CAST(s_suppkey AS VARCHAR) LIKE '7%' THEN 2 WHEN contains(lower(s_name), '7') THEN 3 END AS rank FROM supplier)
SELECT key, name, rank FROM n WHERE rank IS NOT NULL ORDER BY rank, length(name), key LIMIT 10""",
)
def search_names(spark: SparkSession, sf_dir: str, asked: str = "7", most: int = 10) -> DataFrame:
    """The names that best answer a search, a top-k report: the symbol itself, the whole name, a symbol's start, any part of a name."""
    text = asked.lower()
    symbol, name = F.col("s_suppkey").cast("string"), F.lower("s_name")
    rank = F.when(symbol == text, 0).when(name == text, 1).when(symbol.startswith(text), 2).when(name.contains(text), 3)
    found = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), rank.alias("rank")).where("rank is not null")
    return found.orderBy("rank", F.length("name"), "key").limit(most)
