"""Factor returns, residual volatility, scores, risk and portfolio reports on the supplier panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.regress import cross_section, eigenportfolios, rolling_ridge, standardized, weighted_slope
from ..operators.ranges import placed, tile
from ..operators.scores import calibrated, move_z
from ..operators.windows import ew_rms, newest, ordered, safe_corr
from .panel import PANEL, RETS, returns, table
from .registry import query


def by_key():
    return ordered(["key"], "date")


RESID = f"""{RETS}, m AS (SELECT date, avg(ret) AS mkt FROM rets WHERE ret IS NOT NULL GROUP BY 1), resid AS (
  SELECT key, date, ret, dollar_volume, round(ret - mkt, 12) AS resid, row_number() OVER (PARTITION BY key ORDER BY date) AS k FROM rets JOIN m USING (date) WHERE ret IS NOT NULL)"""


def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns less their session's mean, with each row's place in its key's history."""
    rows = returns(spark, sf_dir).where("ret is not null")
    means = rows.groupBy("date").agg(F.avg("ret").alias("mkt"))
    rows = rows.join(means, "date").select("key", "date", "ret", "dollar_volume", F.round(F.col("ret") - F.col("mkt"), 12).alias("resid"))
    return rows.withColumn("k", F.row_number().over(by_key()))


DECAY = 0.5 ** (1 / 12)
OWN = f"""{RESID}, own AS (
  SELECT *, CASE WHEN k - 1 >= 6 THEN sqrt(sum(resid * resid * power({DECAY!r}, -k)) OVER w * power({DECAY!r}, k - 1) * (1 - {DECAY!r}) / (1 - power({DECAY!r}, k - 1))) END AS own_vol FROM resid
  WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def own_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = by_key().rowsBetween(Window.unboundedPreceding, -1)
    return residuals(spark, sf_dir).withColumn("own_vol", ew_rms(F.col("resid"), F.col("k"), before, 12, 6))


@query("ew_spec_vol", f"WITH {OWN} SELECT key, date, round(resid, 7) AS resid, round(own_vol, 8) AS own_vol FROM own")
def ew_spec_vol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals with the weighted volatility of the residuals before them."""
    return own_volatility(spark, sf_dir).select("key", "date", F.round("resid", 7).alias("resid"), F.round("own_vol", 8).alias("own_vol"))


SHRUNK = f"""{OWN}, sized AS (SELECT *, ntile(5) OVER (PARTITION BY date, own_vol IS NULL ORDER BY dollar_volume DESC, key) AS tile FROM own), st AS (
  SELECT *, sum(dollar_volume * own_vol) OVER d / sum(CASE WHEN own_vol IS NOT NULL THEN dollar_volume END) OVER d AS group_vol, stddev_samp(own_vol) OVER d AS spread FROM sized WINDOW d AS (PARTITION BY date, tile)), sh AS (
  SELECT *, coalesce(0.1 * abs(own_vol - group_vol) / nullif(coalesce(spread, 0) + 0.1 * abs(own_vol - group_vol), 0), 0) AS pull FROM st), base AS (
  SELECT *, pull * group_vol + (1 - pull) * own_vol AS base_vol FROM sh)"""


def base_volatility(spark: SparkSession, sf_dir: str, shrink: float = 0.1) -> DataFrame:
    """Own volatility pulled towards that of names of like size, the more the further it is from it."""
    rows = own_volatility(spark, sf_dir).withColumn("new", F.col("own_vol").isNull())
    rows = rows.withColumn("tile", F.ntile(5).over(Window.partitionBy("date", "new").orderBy(F.desc("dollar_volume"), "key")))
    tile = Window.partitionBy("date", "tile")
    known = F.sum(F.when(~F.col("new"), F.col("dollar_volume"))).over(tile)
    rows = rows.withColumn("group_vol", F.try_divide(F.sum(F.col("dollar_volume") * F.col("own_vol")).over(tile), known)).withColumn("spread", F.stddev_samp("own_vol").over(tile))
    gap = shrink * F.abs(F.col("own_vol") - F.col("group_vol"))
    rows = rows.withColumn("pull", F.coalesce(F.try_divide(gap, F.coalesce("spread", F.lit(0.0)) + gap), F.lit(0.0)))
    return rows.withColumn("base_vol", F.col("pull") * F.col("group_vol") + (1 - F.col("pull")) * F.col("own_vol"))


@query("size_decile_shrinkage", f"WITH {SHRUNK} SELECT key, date, tile AS tile, round(pull, 6) AS pull, round(base_vol, 8) AS base_vol FROM base")
def size_decile_shrinkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_volatility(spark, sf_dir).select("key", "date", F.col("tile").cast("long").alias("tile"), F.round("pull", 6).alias("pull"), F.round("base_vol", 8).alias("base_vol"))


REGIME_DECAY = 0.5 ** (1 / 5)


@query(
    "regime_multiplier",
    f"""WITH {SHRUNK}, s AS (SELECT date, row_number() OVER (ORDER BY date) AS t FROM (SELECT DISTINCT date FROM resid) x), z AS (SELECT date, avg(power(resid / base_vol, 2)) AS z2 FROM base WHERE base_vol > 0 GROUP BY 1)
SELECT date, round(coalesce(sqrt(sum(z2 * power({REGIME_DECAY!r}, -t)) OVER w / nullif(sum(CASE WHEN z2 IS NOT NULL THEN power({REGIME_DECAY!r}, -t) END) OVER w, 0)), 1.0), 6) AS regime FROM s LEFT JOIN z USING (date)
WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def regime_multiplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much larger residuals were lately than their forecasts, by session (one row each)."""
    rows = base_volatility(spark, sf_dir)
    z = F.avg(F.when(F.col("base_vol") > 0, F.pow(F.col("resid") / F.col("base_vol"), F.lit(2.0))))
    days = rows.groupBy("date").agg(z.alias("z2")).withColumn("t", F.row_number().over(Window.orderBy("date")))
    before = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.pow(F.lit(REGIME_DECAY), -F.col("t"))
    mean = F.try_divide(F.sum(F.col("z2") * weight).over(before), F.sum(F.when(F.col("z2").isNotNull(), weight)).over(before))
    return days.select("date", F.round(F.coalesce(F.sqrt(mean), F.lit(1.0)), 6).alias("regime"))


ZS = f"""{RETS}, med AS (SELECT date, median(close) AS med, count(close) AS n FROM rets GROUP BY 1), mad AS (SELECT r.date, 1.4826 * median(abs(close - med)) AS mad FROM rets r JOIN med USING (date) GROUP BY 1), x AS (
  SELECT r.*, n, CASE WHEN mad > 0 THEN least(greatest(close, med - 5 * mad), med + 5 * mad) ELSE close END AS x FROM rets r JOIN med USING (date) JOIN mad USING (date)), mo AS (
  SELECT date, sum(x * dollar_volume) / sum(dollar_volume) AS mu, stddev_pop(x) AS sd FROM x GROUP BY 1), z AS (
  SELECT x.*, CASE WHEN n >= 3 AND sd > 0 THEN least(greatest((x - mu) / sd, -3), 3) ELSE 0 END AS z FROM x JOIN mo USING (date))"""


@query("zscore_winsor", f"WITH {ZS} SELECT key, date, round(z, 7) AS z FROM z")
def zscore_winsor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardized(returns(spark, sf_dir), ["date"], "close", "dollar_volume", "z").select("key", "date", F.round("z", 7).alias("z"))


@query(
    "style_slope",
    f"""WITH {ZS}, n AS (SELECT date, z, dollar_volume AS w, lead(ret) OVER (PARTITION BY key ORDER BY date) AS y FROM z), s AS (
  SELECT date, count(*) AS n, sum(w) AS sw, sum(w * z) AS sx, sum(w * y) AS sy, sum(w * z * y) AS sxy, sum(w * z * z) AS sxx FROM n WHERE y IS NOT NULL GROUP BY 1)
SELECT date, n, round((sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0), 6) AS style, round((sy - (sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0) * sx) / sw, 6) AS market FROM s""",
)
def style_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted regression of the next return on one z-score per session, as plain aggregates."""
    rows = standardized(returns(spark, sf_dir), ["date"], "close", "dollar_volume", "z")
    rows = rows.withColumn("y", F.lead("ret").over(by_key())).where("y is not null")
    market, style = weighted_slope(F.col("z"), F.col("y"), F.col("dollar_volume"))
    return rows.groupBy("date").agg(F.count("*").alias("n"), F.round(style, 6).alias("style"), F.round(market, 6).alias("market"))


@query("wls_cross_section")
def wls_cross_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns on two styles and nation regions per session; groups sum to zero by weight. Tested against NumPy."""
    rows = standardized(returns(spark, sf_dir), ["date"], "close", "dollar_volume", "level")
    rows = standardized(rows, ["date"], "volume", "dollar_volume", "size")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    places = table(spark, sf_dir, "supplier").join(nations, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("key"), F.concat(F.lit("region_"), "n_regionkey").alias("region"))
    rows = rows.withColumn("y", F.lead("ret").over(by_key())).join(places, "key")
    fits = cross_section(rows, "date", "y", "dollar_volume", ["level", "size"], group="region", least=8)
    return fits.select("date", "factor", F.round("ret", 8).alias("ret"), "n", F.round("r2", 8).alias("r2"))


@query("pca_walk_forward")
def pca_walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = eigenportfolios(returns(spark, sf_dir), "key", "date", "ret", "dollar_volume", window=36, step=6, k=3, n_names=50)
    return found.select("date", "component", F.round("ret", 7).alias("ret"), F.round("share", 6).alias("share"), "n")


@query("ridge_walk_forward")
def ridge_walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loadings of every key on the market and on the spread of large over small names, refitted each half year."""
    rows = returns(spark, sf_dir).where("ret is not null")
    tile = F.ntile(2).over(Window.partitionBy("date").orderBy("dollar_volume", "key"))
    daily = rows.withColumn("tile", tile).groupBy("date").agg(F.avg("ret").alias("market"), (F.avg(F.when(F.col("tile") == 2, F.col("ret"))) - F.avg(F.when(F.col("tile") == 1, F.col("ret")))).alias("size"))
    fits = rolling_ridge(rows.join(daily, "date"), "key", "date", "ret", ["market", "size"], window=36, step=6, least=24, penalty=5.0)
    return fits.select("key", "fit_date", "factor", F.round("loading", 7).alias("loading"))


CURVE = f"""{RETS}, f AS (SELECT date, key AS factor, ret, row_number() OVER (PARTITION BY key ORDER BY date DESC) AS back FROM rets WHERE ret IS NOT NULL), lv AS (
  SELECT *, exp(sum(ln(1 + ret)) OVER w) AS level FROM f WINDOW w AS (PARTITION BY factor ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), dd AS (
  SELECT *, level / max(level) OVER (PARTITION BY factor ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS below FROM lv)"""


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir).where("ret is not null").select("date", F.col("key").alias("factor"), "ret")
    so_far = ordered(["factor"], "date").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("back", F.row_number().over(Window.partitionBy("factor").orderBy(F.desc("date"))))
    rows = rows.withColumn("level", F.exp(F.sum(F.ln(1 + F.col("ret"))).over(so_far)))
    return rows.withColumn("below", F.col("level") / F.max("level").over(so_far) - 1)


@query("drawdown_curve", f"WITH {CURVE} SELECT factor, date, round(level, 5) AS level, round(below, 6) AS below FROM dd")
def drawdown_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve(spark, sf_dir).select("factor", "date", F.round("level", 5).alias("level"), F.round("below", 6).alias("below"))


@query(
    "factor_performance",
    f"""WITH {CURVE} SELECT factor, min(date) AS first_date, max(date) AS last_date, count(*) AS n, round(exp(sum(ln(1 + ret)) FILTER (WHERE back <= 3)) - 1, 7) AS ret_3, round(exp(sum(ln(1 + ret)) FILTER (WHERE back <= 12)) - 1, 7) AS ret_12,
  round(avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(12), 5) AS sharpe, round(avg(ret) / nullif(stddev_samp(ret) / sqrt(count(*)), 0), 5) AS t, round(min(below), 6) AS max_drawdown FROM dd GROUP BY 1""",
)
def factor_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = lambda n: F.exp(F.sum(F.when(F.col("back") <= n, F.ln(1 + F.col("ret"))))) - 1
    mean, sd = F.avg("ret"), F.stddev_samp("ret")
    return curve(spark, sf_dir).groupBy("factor").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("*").alias("n"),
        F.round(recent(3), 7).alias("ret_3"),
        F.round(recent(12), 7).alias("ret_12"),
        F.round(F.try_divide(mean, sd) * 12**0.5, 5).alias("sharpe"),
        F.round(F.try_divide(mean, sd / F.sqrt(F.count("*"))), 5).alias("t"),
        F.round(F.min("below"), 6).alias("max_drawdown"),
    )


LAM = 0.5 ** (1 / 15)
HORNER = lambda c, x: __import__("functools").reduce(lambda a, b: f"({a} * {x} + ({b!r}))", c[1:], repr(c[0]))


def _two_sided_sql(q: str) -> str:
    from ..functions.scalar import A, B, C, D

    tail, centre = f"sqrt(-2 * ln({q} / 2))", f"({q} / 2 - 0.5)"
    square = f"({centre} * {centre})"
    return f"CASE WHEN {q} < 0.0485 THEN -({HORNER(C, tail)} / {HORNER(D, tail)}) ELSE -({HORNER(A, square)} * {centre} / {HORNER(B, square)}) END"


MOVES = f"""{RETS}, i AS (SELECT CASE WHEN key % 2 = 0 THEN 'even' ELSE 'odd' END AS family, key AS subject, date, ret AS x, 0.02 AS min_sd, key % 7 <> 0 AS elig, row_number() OVER (PARTITION BY key ORDER BY date) AS i FROM rets), sc AS (
  SELECT *, CASE WHEN count(x) OVER w >= 12 THEN greatest(sqrt(sum(x * x * pow({LAM!r}, -i)) OVER w * pow({LAM!r}, i - 1) * (1 - {LAM!r}) / (1 - pow({LAM!r}, count(x) OVER w))), min_sd) END AS sd FROM i
  WINDOW w AS (PARTITION BY family, subject ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)), raw AS (
  SELECT family, subject, 1 AS h, date, elig, x / nullif(sd, 0) AS z_raw FROM sc
  UNION ALL SELECT family, subject, 3, date, elig, CASE WHEN count(x) OVER (PARTITION BY family, subject ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 THEN sum(x) OVER (PARTITION BY family, subject ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / nullif(sd * sqrt(3), 0) END FROM sc)"""


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = F.when(F.col("key") % 2 == 0, "even").otherwise("odd")
    return returns(spark, sf_dir).select(family.alias("family"), F.col("key").alias("subject"), "date", F.col("ret").alias("x"), F.lit(0.02).alias("min_sd"), (F.col("key") % 7 != 0).alias("elig"))


@query("move_scores", f"WITH {MOVES} SELECT family, subject, h, date, round(z_raw, 6) AS z_raw FROM raw WHERE z_raw IS NOT NULL")
def move_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = move_z(moves(spark, sf_dir), [1, 3], half_life=15, window=60, least=12)
    return raw.select("family", "subject", "h", "date", F.round("z_raw", 6).alias("z_raw")).where("z_raw is not null")


@query(
    "calibrated_scores",
    f"""WITH {MOVES}, p AS (SELECT family, subject, h, date, round(z_raw, 6) AS z_raw FROM raw WHERE elig AND z_raw IS NOT NULL), q AS (
  SELECT *, (greatest(count(*) OVER (PARTITION BY family, h ORDER BY abs(z_raw) DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1) - 0.5) / count(*) OVER (PARTITION BY family, h) AS q FROM p)
SELECT family, subject, h, date, round(sign(z_raw) * ({_two_sided_sql("q")}), 6) AS z FROM q""",
)
def calibrated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves as normal quantiles of their rarity in their family's history."""
    raw = move_z(moves(spark, sf_dir), [1, 3], half_life=15, window=60, least=12).withColumn("z_raw", F.round("z_raw", 6))
    return calibrated(raw).select("family", "subject", "h", "date", F.round("z", 6).alias("z"))


@query(
    "related_by_corr",
    f"""WITH {RETS}, p AS (SELECT a.key AS a, b.key AS b, corr(a.ret, b.ret) AS c, count(*) AS n FROM rets a JOIN rets b ON a.date = b.date AND a.key <> b.key WHERE a.key <= 10 AND a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 24), r AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(c, 9) DESC, b) AS place FROM p)
SELECT a, b, n, round(c, 6) AS c, place FROM r WHERE place <= 3""",
)
def related_by_corr(spark: SparkSession, sf_dir: str, asked_for: tuple[int, ...] = tuple(range(11))) -> DataFrame:
    """The three of all names whose returns move most like each name asked for: an equi-join by session, then an aggregate."""
    rows = returns(spark, sf_dir).where("ret is not null")
    a = rows.where(F.col("key").isin(*asked_for)).select("date", F.col("key").alias("a"), F.col("ret").alias("x"))
    b = rows.select("date", F.col("key").alias("b"), F.col("ret").alias("y"))
    pairs = a.join(b, "date").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"), safe_corr(F.col("x"), F.col("y")).alias("c")).where("n >= 24")
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc(F.round("c", 9)), "b")).cast("long")
    return pairs.withColumn("place", place).where("place <= 3").select("a", "b", "n", F.round("c", 6).alias("c"), "place")


@query(
    "portfolio_variance_split",
    f"""WITH {RETS}, r AS (SELECT date, key, ret FROM rets WHERE key <= 12 AND ret IS NOT NULL), w AS (SELECT s_suppkey AS key, CAST(s_suppkey AS DOUBLE) / 78 AS w FROM supplier WHERE s_suppkey <= 12), cov AS (
  SELECT a.key AS a, b.key AS b, covar_samp(a.ret, b.ret) AS c FROM r a JOIN r b USING (date) GROUP BY 1, 2), part AS (
  SELECT a AS key, sum(wa.w * wb.w * c) AS v FROM cov JOIN w wa ON wa.key = a JOIN w wb ON wb.key = b GROUP BY 1)
SELECT key, round(v / sum(v) OVER (), 6) AS share FROM part""",
)
def portfolio_variance_split(spark: SparkSession, sf_dir: str, largest: int = 12) -> DataFrame:
    """Each holding's part of a portfolio's variance; the parts sum to 1. The portfolio holds names 1 to ``largest``, by their numbers."""
    whole = largest * (largest + 1) / 2
    rows = returns(spark, sf_dir).where((F.col("key") <= largest) & F.col("ret").isNotNull()).select("date", "key", "ret", (F.col("key") / whole).alias("w"))
    other = rows.toDF("date", "other", "other_ret", "other_w")
    cov = rows.join(other, "date").groupBy("key", "other").agg((F.first("w") * F.first("other_w") * F.covar_samp("ret", "other_ret")).alias("v"))
    parts = cov.groupBy("key").agg(F.sum("v").alias("v"))
    return parts.select("key", F.round(F.col("v") / F.sum("v").over(Window.partitionBy()), 6).alias("share"))


@query(
    "attribution_two_ways",
    f"""WITH {RETS}, j AS (SELECT date, n_regionkey AS region, ret, dollar_volume AS w FROM rets JOIN supplier ON s_suppkey = key JOIN nation ON n_nationkey = s_nationkey WHERE ret IS NOT NULL)
SELECT date, CAST(region AS BIGINT) AS region, count(*) AS n, round(avg(ret), 12) AS equal_ret, round(sum(w * ret) / sum(w), 8) AS weighted_ret, round(sum(w) / sum(sum(w)) OVER (PARTITION BY date), 8) AS share FROM j GROUP BY 1, 2""",
)
def attribution_two_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    places = table(spark, sf_dir, "supplier").join(nations, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("key"), F.col("n_regionkey").cast("long").alias("region"))
    rows = returns(spark, sf_dir).where("ret is not null").join(places, "key")
    w = F.col("dollar_volume")
    grouped = rows.groupBy("date", "region").agg(F.count("*").alias("n"), F.round(F.avg("ret"), 12).alias("equal_ret"), F.round(F.sum(w * F.col("ret")) / F.sum(w), 8).alias("weighted_ret"), F.sum(w).alias("w"))
    return grouped.withColumn("share", F.round(F.col("w") / F.sum("w").over(Window.partitionBy("date")), 8)).drop("w")


@query(
    "exceptions_text",
    f"""WITH {RETS}, s AS (SELECT *, avg(ret) OVER w AS m, stddev_samp(ret) OVER w AS sd, count(ret) OVER w AS n FROM rets WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)), z AS (
  SELECT key, date, ret, (ret - m) / nullif(sd, 0) AS z FROM s WHERE n >= 12)
SELECT key, date, printf('%d %+.1f%% on the month, %+.1f sigma', key, ret * 100, z) AS message, CAST(sign(z) AS INT) AS direction FROM z WHERE abs(z) >= 2""",
)
def exceptions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves of two deviations or more, in words."""
    w = by_key().rowsBetween(-24, -1)
    rows = returns(spark, sf_dir).select("key", "date", "ret", F.try_divide(F.col("ret") - F.avg("ret").over(w), F.stddev_samp("ret").over(w)).alias("z"), F.count("ret").over(w).alias("n"))
    rows = rows.where("n >= 12 and abs(z) >= 2")
    text = F.format_string("%d %+.1f%% on the month, %+.1f sigma", "key", F.col("ret") * 100, "z")
    return rows.select("key", "date", text.alias("message"), F.signum("z").cast("int").alias("direction"))


@query(
    "market_breadth",
    f"""WITH {RETS}, a AS (SELECT *, avg(close) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ma, max(close) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS high FROM rets), d AS (
  SELECT date, count(*) FILTER (WHERE ret > 0) AS advancers, count(*) FILTER (WHERE ret < 0) AS decliners, round(avg(CASE WHEN close > ma THEN 1.0 ELSE 0.0 END), 7) AS above_ma, count(*) FILTER (WHERE close >= high) AS highs FROM a WHERE ret IS NOT NULL GROUP BY 1)
SELECT *, CAST(sum(advancers - decliners) OVER (ORDER BY date) AS BIGINT) AS ad_line FROM d""",
)
def market_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = by_key().rowsBetween(-11, 0)
    rows = returns(spark, sf_dir).withColumn("ma", F.avg("close").over(year)).withColumn("high", F.max("close").over(year)).where("ret is not null")
    days = rows.groupBy("date").agg(
        F.count_if(F.col("ret") > 0).alias("advancers"),
        F.count_if(F.col("ret") < 0).alias("decliners"),
        F.round(F.avg(F.when(F.col("close") > F.col("ma"), 1.0).otherwise(0.0)), 7).alias("above_ma"),
        F.count_if(F.col("close") >= F.col("high")).alias("highs"),
    )
    return days.withColumn("ad_line", F.sum(F.col("advancers") - F.col("decliners")).over(Window.orderBy("date")))  # one row a session


@query(
    "cap_run_refusal",
    f"""WITH {RETS}, c AS (SELECT key, date, volume AS v, lag(volume) OVER (PARTITION BY key ORDER BY date) AS prev FROM rets), j AS (
  SELECT *, coalesce(greatest(v / prev, prev / v) > 1.4, false) AS starts FROM c), r AS (
  SELECT *, sum(CAST(starts AS INT)) OVER (PARTITION BY key ORDER BY date ROWS UNBOUNDED PRECEDING) AS run, first_value(CASE WHEN starts THEN v END IGNORE NULLS) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM j), b AS (
  SELECT *, count(*) OVER (PARTITION BY key, run) AS pulls, max(CASE WHEN starts THEN prev END) OVER (PARTITION BY key, run) AS before FROM r)
SELECT key, date, CAST(run AS BIGINT) AS run, pulls, coalesce(pulls <= 6 AND greatest(before / after, after / before) <= 1.25, false) AS refused FROM b""",
)
def cap_run_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short runs of values that jump away and come back to about where they were are refused."""
    w = by_key()
    rows = returns(spark, sf_dir).select("key", "date", F.col("volume").alias("v"), F.lag("volume").over(w).alias("prev"))
    rows = rows.withColumn("starts", F.coalesce(F.greatest(F.col("v") / F.col("prev"), F.col("prev") / F.col("v")) > 1.4, F.lit(False)))
    rows = rows.withColumn("run", F.sum(F.col("starts").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("after", F.first(F.when(F.col("starts"), F.col("v")), True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    run = Window.partitionBy("key", "run")
    rows = rows.withColumn("pulls", F.count("*").over(run)).withColumn("before", F.max(F.when(F.col("starts"), F.col("prev"))).over(run))
    near = F.greatest(F.col("before") / F.col("after"), F.col("after") / F.col("before")) <= 1.25
    return rows.select("key", "date", "run", "pulls", F.coalesce((F.col("pulls") <= 6) & near, F.lit(False)).alias("refused"))


@query(
    "holdings_alpha",
    f"""WITH {SHRUNK}, last AS (SELECT key, base_vol, ntile(5) OVER (ORDER BY base_vol, key) AS q FROM base WHERE date = (SELECT max(date) FROM base) AND base_vol IS NOT NULL), z AS (
  SELECT key, base_vol, least(greatest(-(q - avg(q) OVER ()) / nullif(stddev_pop(q) OVER (), 0), -3), 3) AS z FROM last), h AS (
  SELECT p_brand AS fund, l_suppkey AS key, sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (PARTITION BY p_brand) AS weight FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT fund, count(*) AS n, round(sum(weight), 7) AS covered, round(sum(weight * 0.5 * 0.047 * sqrt(12) * sqrt(12) * base_vol * z) / sum(weight), 8) AS forecast FROM h JOIN z USING (key) GROUP BY 1""",
)
def holdings_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted forecasts of what funds hold: skill times volatility times score, over the covered weight."""
    rows = newest(base_volatility(spark, sf_dir).withColumn("one", F.lit(1)), ["key"], F.desc("date"))
    top = rows.agg(F.max("date").alias("date"))
    rows = rows.join(F.broadcast(top), "date").where("base_vol is not null")  # one row
    rows = placed(rows.select("key", "base_vol"), "base_vol", "key").select("key", "base_vol", tile(F.col("place"), F.col("n"), 5).alias("q"))
    rows = rows.crossJoin(F.broadcast(rows.agg(F.avg("q").alias("mean"), F.stddev_pop("q").alias("sd"))))  # one row
    z = -F.try_divide(F.col("q") - F.col("mean"), F.col("sd"))
    scores = rows.select("key", "base_vol", F.least(F.greatest(z, F.lit(-3.0)), F.lit(3.0)).alias("z"))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    value = lines.groupBy(F.col("p_brand").alias("fund"), F.col("l_suppkey").alias("key")).agg(F.sum("l_extendedprice").alias("v"))
    weights = value.select("fund", "key", (F.col("v") / F.sum("v").over(Window.partitionBy("fund"))).alias("weight"))
    own = 0.5 * 0.047 * 12 * F.col("base_vol") * F.col("z")
    return weights.join(scores, "key").groupBy("fund").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 7).alias("covered"), F.round(F.sum(F.col("weight") * own) / F.sum("weight"), 8).alias("forecast"))


@query(
    "heatmap_top",
    f"WITH {PANEL} SELECT key, round(sum(dollar_volume), 2) AS total FROM panel GROUP BY 1 ORDER BY total DESC, key LIMIT 20",
)
def heatmap_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty largest keys: a top-k report."""
    return returns(spark, sf_dir).groupBy("key").agg(F.round(F.sum("dollar_volume"), 2).alias("total")).orderBy(F.desc("total"), "key").limit(20)


@query(
    "series_moments",
    f"""WITH {RETS}, m AS (SELECT key, count(*) AS n, avg(ret) AS mean, stddev_samp(ret) AS sd FROM rets WHERE ret IS NOT NULL GROUP BY 1 HAVING count(*) >= 24)
SELECT key, any_value(n) AS n, round(any_value(mean), 7) AS mean, round(any_value(sd), 7) AS sd, round(avg(pow((ret - mean) / sd, 3)), 5) AS skew, round(avg(pow((ret - mean) / sd, 4)) - 3, 5) AS kurtosis FROM rets JOIN m USING (key) WHERE ret IS NOT NULL GROUP BY 1""",
)
def series_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, sample deviation, and skewness and excess kurtosis over that deviation."""
    rows = returns(spark, sf_dir).where("ret is not null")
    moments = rows.groupBy("key").agg(F.count("*").alias("n"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("sd"), F.var_pop("ret").alias("vp"), F.skewness("ret").alias("g1"), F.kurtosis("ret").alias("g2")).where("n >= 24")
    ratio = F.sqrt("vp") / F.col("sd")
    return moments.select("key", "n", F.round("mean", 7).alias("mean"), F.round("sd", 7).alias("sd"), F.round(F.col("g1") * F.pow(ratio, F.lit(3)), 5).alias("skew"), F.round((F.col("g2") + 3) * F.pow(ratio, F.lit(4)) - 3, 5).alias("kurtosis"))


@query(
    "dickey_fuller",
    f"""WITH {RETS}, d AS (SELECT key, close - lag(close) OVER w AS y, lag(close) OVER w AS x FROM rets WINDOW w AS (PARTITION BY key ORDER BY date)), s AS (
  SELECT key, regr_slope(y, x) AS b, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, count(*) AS n FROM d WHERE y IS NOT NULL GROUP BY 1 HAVING count(*) >= 24)
SELECT key, round(b, 7) AS slope, round(b / nullif(sqrt((syy - b * b * sxx) / (n - 2) / sxx), 0), 4) AS t, CASE WHEN b > -1 AND b < 0 THEN round(-ln(2) / ln(1 + b), 4) END AS half_life FROM s""",
)
def dickey_fuller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each series reverts: the t of its change on its level, and the half-life that the slope implies."""
    w = by_key()
    rows = returns(spark, sf_dir).select("key", (F.col("close") - F.lag("close").over(w)).alias("y"), F.lag("close").over(w).alias("x")).where("y is not null")
    fit = rows.groupBy("key").agg(F.regr_slope("y", "x").alias("b"), F.regr_sxx("y", "x").alias("sxx"), F.regr_syy("y", "x").alias("syy"), F.count("*").alias("n")).where("n >= 24")
    se = F.sqrt((F.col("syy") - F.col("b") * F.col("b") * F.col("sxx")) / (F.col("n") - 2) / F.col("sxx"))
    half = F.when((F.col("b") > -1) & (F.col("b") < 0), F.round(-F.ln(F.lit(2.0)) / F.ln(1 + F.col("b")), 4))
    return fit.select("key", F.round("b", 7).alias("slope"), F.round(F.try_divide(F.col("b"), se), 4).alias("t"), half.alias("half_life"))
