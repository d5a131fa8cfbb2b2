"""Scans, joins, aggregates, windows, reshaping and chains: one query for each relational operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import par_bond_return
from ..operators.joins import asof_join, overlaps, span_join, trailing_sum
from ..operators.reshape import chain_roots, pivot_first, unpivot_known
from ..operators.windows import compounded, enough, filled, island, newest, ordered, top_k, trailing
from .panel import PANEL, RETS, panel, panel_sql, returns, table
from .registry import query


def by_key():
    return ordered(["key"], "date")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last view of each user and moment."""
    seen = table(spark, sf_dir, "events").where("event_type = 'view'")
    return seen.groupBy("user_id", F.col("ts").alias("view_ts")).agg(F.max("value").alias("view_value"))


VIEWS = "v AS (SELECT user_id, ts AS view_ts, max(value) AS view_value FROM events WHERE event_type = 'view' GROUP BY 1, 2), p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')"


def asof_sql(kind: str, op: str) -> str:
    return f"WITH {VIEWS} SELECT p.event_id, p.user_id, p.ts, p.value, v.view_ts, v.view_value FROM p ASOF {kind} JOIN v ON p.user_id = v.user_id AND p.ts {op} v.view_ts"


@query("asof_backward", asof_sql("LEFT", ">="))
def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_join(purchases(spark, sf_dir), views(spark, sf_dir), "ts", "view_ts", ["user_id"])


@query("asof_strict_before", asof_sql("LEFT", ">"))
def asof_strict_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_join(purchases(spark, sf_dir), views(spark, sf_dir), "ts", "view_ts", ["user_id"], strict=True)


@query("asof_forward", asof_sql("LEFT", "<="))
def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_join(purchases(spark, sf_dir), views(spark, sf_dir), "ts", "view_ts", ["user_id"], direction="forward")


@query("asof_inner_forward_strict", asof_sql("", "<"))
def asof_inner_forward_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_join(purchases(spark, sf_dir), views(spark, sf_dir), "ts", "view_ts", ["user_id"], direction="forward", strict=True, how="inner")


@query(
    "asof_tolerance",
    f"""WITH {VIEWS}, j AS (SELECT p.event_id, p.ts, v.view_ts, v.view_value FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts)
SELECT event_id, CASE WHEN date_diff('day', view_ts::DATE, ts::DATE) <= 1 THEN view_ts END AS view_ts, CASE WHEN date_diff('day', view_ts::DATE, ts::DATE) <= 1 THEN view_value END AS view_value FROM j""",
)
def asof_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match more than a day old is no match."""
    found = asof_join(purchases(spark, sf_dir), views(spark, sf_dir), "ts", "view_ts", ["user_id"], tolerance=1)
    return found.select("event_id", "view_ts", "view_value")


@query(
    "span_join_adjust",
    f"""WITH {PANEL}, ev AS (SELECT o_custkey % 100 + 1 AS key, CAST(date_trunc('month', o_orderdate) AS DATE) AS start, round(1 + (count(*) % 5) / 10.0, 4) AS factor FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 20 = 0 GROUP BY 1, 2), sp AS (
  SELECT *, lead(start) OVER (PARTITION BY key ORDER BY start) AS stop FROM ev)
SELECT p.key, p.date, p.close, sp.start, round(p.close * coalesce(sp.factor, 1), 6) AS adjusted FROM panel p LEFT JOIN sp ON sp.key = p.key AND p.date >= sp.start AND (sp.stop IS NULL OR p.date < sp.stop)""",
)
def span_join_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices times the factor of the span that holds their session, 1 before the first span."""
    orders = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' and o_orderkey % 20 = 0")
    events = orders.groupBy((F.col("o_custkey") % 100 + 1).alias("key"), F.trunc("o_orderdate", "month").alias("start"))
    events = events.agg(F.round(1 + (F.count("*") % 5) / 10, 4).alias("factor"))
    joined = span_join(panel(spark, sf_dir), events, ["key"], "date", "start")
    return joined.select("key", "date", "close", "start", F.round(F.col("close") * F.coalesce("factor", F.lit(1.0)), 6).alias("adjusted"))


@query(
    "between_join_ranges",
    """WITH bands AS (SELECT * FROM (VALUES ('small', 1, 15), ('medium', 16, 30), ('large', 31, 45)) t(band, low, high))
SELECT coalesce(band, 'other') AS band, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN bands ON p_size BETWEEN low AND high GROUP BY 1""",
)
def between_join_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by the size range of their part; the three ranges are a broadcast table of fixed size."""
    bands = spark.createDataFrame([("small", 1, 15), ("medium", 16, 30), ("large", 31, 45)], "band string, low int, high int")
    # The bands are a fixed list.
    parts = table(spark, sf_dir, "part").join(F.broadcast(bands), F.col("p_size").between(F.col("low"), F.col("high")), "left")
    lines = table(spark, sf_dir, "lineitem").join(parts, F.col("p_partkey") == F.col("l_partkey"))
    return lines.groupBy(F.coalesce("band", F.lit("other")).alias("band")).agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query(
    "trailing_range_join_ttm",
    f"""WITH {PANEL}, ev AS (SELECT o_custkey % 100 + 1 AS key, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS cash FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT p.key, p.date, round(coalesce(sum(cash), 0), 2) AS ttm FROM panel p LEFT JOIN ev ON ev.key = p.key AND ev.day > p.date - 365 AND ev.day <= p.date GROUP BY 1, 2""",
)
def trailing_range_join_ttm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash of the 365 days up to each session."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    events = orders.groupBy((F.col("o_custkey") % 100 + 1).alias("key"), F.col("o_orderdate").cast("date").alias("day")).agg(F.sum("o_totalprice").alias("cash"))
    summed = trailing_sum(panel(spark, sf_dir).select("key", "date"), events, ["key"], "date", "day", "cash", 365, "ttm")
    return summed.select("key", "date", F.round("ttm", 2).alias("ttm"))


@query(
    "semi_multi_key",
    "SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P') AND EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = c.c_nationkey AND s.s_acctbal > 5000)",
)
def semi_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    rich = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    return customers.join(pending, "c_custkey", "left_semi").join(rich, "c_nationkey", "left_semi").select("c_custkey", "c_name")


@query(
    "anti_new_keys",
    "WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'), b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01') SELECT a.* FROM a ANTI JOIN b USING (l_partkey, l_suppkey)",
)
def anti_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that first appear from 1999 on."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    late, early = lines.where("l_shipdate >= timestamp '1999-01-01'"), lines.where("l_shipdate < timestamp '1999-01-01'")
    return late.select("l_partkey", "l_suppkey").distinct().join(early, ["l_partkey", "l_suppkey"], "left_anti")


@query(
    "null_safe_self_join",
    f"""WITH {RETS}, m AS (SELECT key, date, CASE WHEN i % 5 = 0 THEN NULL ELSE CAST(i % 3 AS BIGINT) END AS tag FROM rets), t AS (SELECT key, tag, min(date) AS first_date FROM m GROUP BY 1, 2)
SELECT m.key, m.date, m.tag, t.first_date FROM m JOIN t ON m.key = t.key AND m.tag IS NOT DISTINCT FROM t.tag""",
)
def null_safe_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir).select("key", "date", F.when(F.col("i") % 5 != 0, (F.col("i") % 3).cast("long")).alias("tag"))
    firsts = rows.groupBy(F.col("key").alias("k"), F.col("tag").alias("t")).agg(F.min("date").alias("first_date"))
    return rows.join(firsts, (F.col("key") == F.col("k")) & F.col("tag").eqNullSafe(F.col("t"))).select("key", "date", "tag", "first_date")


@query(
    "arg_max_latest",
    "SELECT o_custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS last_order, max(o_orderdate) AS last_date, count(*) AS n, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY 1",
)
def arg_max_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest_order = F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(newest_order.alias("last_order"), F.max("o_orderdate").alias("last_date"), F.count("*").alias("n"), F.countDistinct("o_orderpriority").alias("priorities"))


@query(
    "filtered_board",
    """SELECT s_name, round(sum(l_extendedprice) FILTER (WHERE year(l_shipdate) = 1996), 2) AS rev_1996, round(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 2) AS returned,
  count(*) FILTER (WHERE l_quantity > 40) AS large_lines, count(DISTINCT l_partkey) AS parts FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""",
)
def filtered_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("s_suppkey") == F.col("l_suppkey"))
    price = F.col("l_extendedprice")
    return lines.groupBy("s_name").agg(
        F.round(F.sum(F.when(F.year("l_shipdate") == 1996, price)), 2).alias("rev_1996"),
        F.round(F.sum(F.when(F.col("l_returnflag") == "R", price)), 2).alias("returned"),
        F.count_if(F.col("l_quantity") > 40).alias("large_lines"),
        F.countDistinct("l_partkey").alias("parts"),
    )


@query(
    "winsorized_mean",
    f"""WITH {RETS}, q AS (SELECT date, quantile_cont(ret, 0.05) AS lo, quantile_cont(ret, 0.95) AS hi FROM rets WHERE ret IS NOT NULL GROUP BY 1)
SELECT date, count(*) AS n, round(avg(least(greatest(ret, lo), hi)), 8) AS mean_w, round(any_value(hi) - any_value(lo), 8) AS band FROM rets JOIN q USING (date) WHERE ret IS NOT NULL GROUP BY 1""",
)
def winsorized_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir).where("ret is not null")
    limits = rows.groupBy("date").agg(F.percentile("ret", 0.05).alias("lo"), F.percentile("ret", 0.95).alias("hi"))
    clipped = F.least(F.greatest("ret", "lo"), F.col("hi"))
    return rows.join(limits, "date").groupBy("date").agg(F.count("*").alias("n"), F.round(F.avg(clipped), 8).alias("mean_w"), F.round(F.first("hi") - F.first("lo"), 8).alias("band"))


@query("quantile_dispersion", f"WITH {RETS} SELECT date, round((quantile_cont(ret, 0.75) - quantile_cont(ret, 0.25)) / 1.349, 8) AS dispersion, round(median(ret), 8) AS middle FROM rets WHERE ret IS NOT NULL GROUP BY 1")
def quantile_dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir).where("ret is not null")
    return rows.groupBy("date").agg(F.round((F.percentile("ret", 0.75) - F.percentile("ret", 0.25)) / 1.349, 8).alias("dispersion"), F.round(F.median("ret"), 8).alias("middle"))


@query(
    "bool_flags_rollup",
    "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned, bool_and(l_linestatus = 'O') AS all_open, min(l_returnflag) <> max(l_returnflag) AS mixed FROM lineitem GROUP BY 1",
)
def bool_flags_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    mixed = F.min("l_returnflag") != F.max("l_returnflag")
    return lines.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"), F.bool_and(F.col("l_linestatus") == "O").alias("all_open"), mixed.alias("mixed"))


@query("product_compounding", f"WITH {RETS} SELECT key, year(date) AS year, round(product(1 + ret) - 1, 6) AS compounded, round(exp(sum(ln(1 + ret))) - 1, 6) AS by_logs FROM rets WHERE ret IS NOT NULL GROUP BY 1, 2")
def product_compounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = returns(spark, sf_dir).where("ret is not null")
    return rows.groupBy("key", F.year("date").cast("long").alias("year")).agg(F.round(F.product(1 + F.col("ret")) - 1, 6).alias("compounded"), F.round(F.exp(F.sum(F.ln(1 + F.col("ret")))) - 1, 6).alias("by_logs"))


@query(
    "string_agg_history",
    """WITH m AS (SELECT l_partkey AS key, CAST(date_trunc('year', l_shipdate) AS DATE) AS y, max(l_returnflag) AS f FROM lineitem GROUP BY 1, 2), r AS (SELECT *, lag(f) OVER (PARTITION BY key ORDER BY y) AS prev FROM m)
SELECT key, string_agg(f, ' > ' ORDER BY y) AS history, count(*) AS runs FROM r WHERE prev IS DISTINCT FROM f GROUP BY 1""",
)
def string_agg_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's flags by year, runs written once."""
    yearly = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("key"), F.trunc("l_shipdate", "year").alias("y")).agg(F.max("l_returnflag").alias("f"))
    runs = yearly.withColumn("prev", F.lag("f").over(ordered(["key"], "y"))).where(~F.col("prev").eqNullSafe(F.col("f")))
    names = F.transform(F.array_sort(F.collect_list(F.struct("y", "f"))), lambda r: r["f"])
    return runs.groupBy("key").agg(F.array_join(names, " > ").alias("history"), F.count("*").alias("runs"))


@query(
    "lag_lead_returns",
    f"WITH {RETS} SELECT key, date, ret, round(close / lag(close, 5) OVER w - 1, 8) AS ret_5, lead(date, 1) OVER w AS next_date, first_value(close) OVER w AS first_close FROM rets WINDOW w AS (PARTITION BY key ORDER BY date)",
)
def lag_lead_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = by_key()
    return returns(spark, sf_dir).select("key", "date", "ret", F.round(F.col("close") / F.lag("close", 5).over(w) - 1, 8).alias("ret_5"), F.lead("date", 1).over(w).alias("next_date"), F.first("close").over(w).alias("first_close"))


@query(
    "rolling_stats",
    f"""WITH {RETS} SELECT key, date, round(avg(close) OVER a, 8) AS ma_5, round(max(volume) OVER a, 2) AS high_5, CASE WHEN count(ret) OVER b >= 12 THEN round(stddev_samp(ret) OVER b, 8) END AS vol_12 FROM rets
WINDOW a AS (PARTITION BY key ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), b AS (PARTITION BY key ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def rolling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = trailing(by_key(), 5), trailing(by_key(), 12)
    return returns(spark, sf_dir).select("key", "date", F.round(F.avg("close").over(a), 8).alias("ma_5"), F.round(F.max("volume").over(a), 2).alias("high_5"), enough(F.round(F.stddev_samp("ret").over(b), 8), F.count("ret").over(b), 12).alias("vol_12"))


@query(
    "adv_prior_window",
    f"WITH {PANEL} SELECT key, date, round(avg(dollar_volume) OVER w, 7) AS adv, count(dollar_volume) OVER w AS days FROM panel WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)",
)
def adv_prior_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = trailing(by_key(), 20, 1)
    return panel(spark, sf_dir).select("key", "date", F.round(F.avg("dollar_volume").over(w), 7).alias("adv"), F.count("dollar_volume").over(w).alias("days"))


@query(
    "expanding_z",
    f"""WITH {PANEL} SELECT key, date, CASE WHEN count(*) OVER w >= 12 THEN round((volume - avg(volume) OVER w) / nullif(stddev_samp(volume) OVER w, 0), 6) END AS z FROM panel
WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def expanding_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume against all earlier rows, from twelve of them on."""
    w = by_key().rowsBetween(Window.unboundedPreceding, -1)
    z = F.try_divide(F.col("volume") - F.avg("volume").over(w), F.stddev_samp("volume").over(w))
    return panel(spark, sf_dir).select("key", "date", F.round(enough(z, F.count("*").over(w), 12), 6).alias("z"))


@query(
    "offset_frame_value",
    f"""WITH {RETS} SELECT key, date, CASE WHEN count(ret) OVER w = 12 THEN round(exp(sum(ln(1 + ret)) OVER w) - 1, 6) END AS far FROM rets
WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 23 PRECEDING AND 12 PRECEDING)""",
)
def offset_frame_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the twelve rows before the last twelve compounded to."""
    w = trailing(by_key(), 12, 12)
    return returns(spark, sf_dir).select("key", "date", F.round(enough(compounded("ret", w), F.count("ret").over(w), 12), 6).alias("far"))


RATES = """days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events), cells AS (
  SELECT CAST(ts AS DATE) AS date, event_type, round(avg(value), 6) AS value FROM events GROUP BY 1, 2), sparse AS (
  SELECT * FROM cells WHERE (day(date) + length(event_type)) % 3 <> 0), wide AS (
  SELECT date, any_value(value) FILTER (WHERE event_type = 'view') AS view, any_value(value) FILTER (WHERE event_type = 'click') AS click, any_value(value) FILTER (WHERE event_type = 'error') AS error FROM sparse GROUP BY 1)"""


@query(
    "ffill_pivot_rates",
    f"""WITH {RATES} SELECT date, last_value(view IGNORE NULLS) OVER w AS view, last_value(click IGNORE NULLS) OVER w AS click, last_value(error IGNORE NULLS) OVER w AS error FROM days LEFT JOIN wide USING (date)
WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def ffill_pivot_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse daily series pivoted by a fixed list of names and filled forward."""
    events = table(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    cells = events.groupBy("date", "event_type").agg(F.round(F.avg("value"), 6).alias("value"))
    names = ["view", "click", "error"]
    wide = pivot_first(cells.where((F.day("date") + F.length("event_type")) % 3 != 0), "date", "event_type", "value", names)
    rows = events.select("date").distinct().join(wide, "date", "left")
    w = Window.orderBy("date")  # one row a calendar day
    return rows.select("date", *[filled(c, w).alias(c) for c in names])


@query(
    "islands_runs",
    f"""WITH {panel_sql("l_partkey")}, f AS (SELECT key, date, year(date) * 12 + month(date) AS m FROM panel), g AS (
  SELECT *, CASE WHEN m - lag(m) OVER (PARTITION BY key ORDER BY date) = 1 THEN 0 ELSE 1 END AS new FROM f), r AS (
  SELECT *, sum(new) OVER (PARTITION BY key ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT key, CAST(run AS BIGINT) AS run, min(date) AS first_date, max(date) AS last_date, count(*) AS n FROM r GROUP BY 1, 2""",
)
def islands_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive months."""
    w = ordered(["key"], "date")
    rows = panel(spark, sf_dir, "l_partkey").select("key", "date", (F.year("date") * 12 + F.month("date")).alias("m"))
    rows = rows.withColumn("new", ~F.coalesce(F.col("m") - F.lag("m").over(w) == 1, F.lit(False)))
    rows = rows.withColumn("run", island(F.col("new"), w))
    return rows.groupBy("key", "run").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n"))


@query(
    "one_day_flip_smoothing",
    f"""WITH {RETS}, f AS (SELECT key, date, CAST(close > 1500 AS INT) AS state FROM rets), n AS (SELECT *, lag(state) OVER w AS before, lead(state) OVER w AS after FROM f WINDOW w AS (PARTITION BY key ORDER BY date))
SELECT key, date, state, CASE WHEN before = after AND before <> state THEN before ELSE state END AS smooth FROM n""",
)
def one_day_flip_smoothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state that differs from two equal neighbours takes theirs."""
    w = by_key()
    rows = panel(spark, sf_dir).select("key", "date", (F.col("close") > 1500).cast("int").alias("state"))
    rows = rows.withColumn("before", F.lag("state").over(w)).withColumn("after", F.lead("state").over(w))
    flip = (F.col("before") == F.col("after")) & (F.col("before") != F.col("state"))
    return rows.select("key", "date", "state", F.when(flip, F.col("before")).otherwise(F.col("state")).alias("smooth"))


@query(
    "fill_both_ways",
    f"""WITH {RETS}, s AS (SELECT key, date, CASE WHEN i % 4 = 0 THEN close END AS seen FROM rets)
SELECT key, date, last_value(seen IGNORE NULLS) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier,
  first_value(seen IGNORE NULLS) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM s""",
)
def fill_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value known before each row and the first known after it."""
    w = by_key()
    rows = returns(spark, sf_dir).select("key", "date", F.when(F.col("i") % 4 == 0, F.col("close")).alias("seen"))
    earlier = F.last("seen", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    later = F.first("seen", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return rows.select("key", "date", earlier.alias("earlier"), later.alias("later"))


@query(
    "recursive_links",
    """WITH RECURSIVE l AS (SELECT DISTINCT n_nationkey AS new, n_nationkey // 2 AS old FROM nation WHERE n_nationkey > 1), c AS (
  SELECT CAST(old AS BIGINT) AS root, CAST(new AS BIGINT) AS member, CAST(1 AS BIGINT) AS steps FROM l WHERE old NOT IN (SELECT new FROM l)
  UNION ALL SELECT c.root, CAST(l.new AS BIGINT), c.steps + 1 FROM c JOIN l ON l.old = c.member) SELECT member, root, steps FROM c""",
)
def recursive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every member of a chain of links with the chain's first member."""
    nations = table(spark, sf_dir, "nation").where("n_nationkey > 1")
    links = nations.select(F.col("n_nationkey").cast("long").alias("new"), F.floor(F.col("n_nationkey") / 2).cast("long").alias("old"))
    return chain_roots(links)


@query(
    "ntile_crowding",
    f"""WITH {RETS}, t AS (SELECT date, key, ntile(5) OVER (PARTITION BY date ORDER BY dollar_volume, key) AS tile, ret FROM rets WHERE ret IS NOT NULL)
SELECT date, round(avg(ret) FILTER (WHERE tile = 1) - avg(ret) FILTER (WHERE tile = 5), 7) AS spread FROM t GROUP BY 1""",
)
def ntile_crowding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tile = F.ntile(5).over(Window.partitionBy("date").orderBy("dollar_volume", "key"))
    rows = returns(spark, sf_dir).where("ret is not null").select("date", "ret", tile.alias("tile"))
    side = lambda k: F.avg(F.when(F.col("tile") == k, F.col("ret")))
    return rows.groupBy("date").agg(F.round(side(1) - side(5), 7).alias("spread"))


@query(
    "percent_rank_level",
    f"WITH {PANEL}, r AS (SELECT key, date, close, percent_rank() OVER (PARTITION BY key ORDER BY close NULLS LAST) AS p, row_number() OVER (PARTITION BY key ORDER BY date DESC) AS back FROM panel) SELECT key, date, round(p, 8) AS pctile FROM r WHERE back = 1",
)
def percent_rank_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each key's newest close stands in its own history."""
    rows = panel(spark, sf_dir).withColumn("pctile", F.round(F.percent_rank().over(ordered(["key"], "close")), 8))
    return newest(rows, ["key"], F.desc("date")).select("key", "date", "pctile")


@query(
    "top_contributors",
    f"""WITH {RETS}, r AS (SELECT date, key, ret, row_number() OVER (PARTITION BY date ORDER BY ret DESC, key) AS place FROM rets WHERE ret IS NOT NULL) SELECT date, key, ret, place FROM r WHERE place <= 3""",
)
def top_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(returns(spark, sf_dir).where("ret is not null"), ["date"], 3, F.desc("ret"), F.asc("key")).select("date", "key", "ret", F.col("place").cast("long").alias("place"))


@query(
    "unpivot_factor_returns",
    f"WITH {PANEL}, u AS (SELECT key, date, close, volume, CASE WHEN n_lines > 5 THEN CAST(n_lines AS DOUBLE) END AS lines FROM panel) SELECT key, date, factor, value FROM u UNPIVOT (value FOR factor IN (close, volume, lines))",
)
def unpivot_factor_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel(spark, sf_dir).withColumn("lines", F.when(F.col("n_lines") > 5, F.col("n_lines").cast("double")))
    return unpivot_known(rows, ["key", "date"], ["close", "volume", "lines"], "factor", "value")


@query(
    "index_adds_drops",
    """WITH m AS (SELECT DISTINCT CAST(date_trunc('year', l_shipdate) AS DATE) AS y, l_partkey AS part FROM lineitem), c AS (SELECT y, part, lead(y) OVER (PARTITION BY part ORDER BY y) AS next_y, lag(y) OVER (PARTITION BY part ORDER BY y) AS prev_y FROM m)
SELECT y, count(*) AS members, count(*) FILTER (WHERE prev_y IS NULL OR year(prev_y) < year(y) - 1) AS added, count(*) FILTER (WHERE next_y IS NULL OR year(next_y) > year(y) + 1) AS dropped FROM c GROUP BY 1""",
)
def index_adds_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of each year, those that were not there the year before, and those gone the year after."""
    members = table(spark, sf_dir, "lineitem").select(F.trunc("l_shipdate", "year").alias("y"), F.col("l_partkey").alias("part")).distinct()
    w = ordered(["part"], "y")
    rows = members.withColumn("gap", F.year("y") - F.year(F.lag("y").over(w))).withColumn("ahead", F.year(F.lead("y").over(w)) - F.year("y"))
    return rows.groupBy("y").agg(F.count("*").alias("members"), F.count_if(F.coalesce(F.col("gap") > 1, F.lit(True))).alias("added"), F.count_if(F.coalesce(F.col("ahead") > 1, F.lit(True))).alias("dropped"))


@query(
    "holdings_overlap",
    """WITH w AS (SELECT l_suppkey AS fund, p_brand AS line, sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (PARTITION BY l_suppkey) AS weight FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT a.fund AS a, b.fund AS b, round(sum(least(a.weight, b.weight)), 6) AS overlap FROM w a JOIN w b ON a.line = b.line AND a.fund < b.fund GROUP BY 1, 2""",
)
def holdings_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared weight of each pair of funds: the sum over lines of the smaller weight, block by block."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    value = lines.groupBy(F.col("l_suppkey").alias("fund"), F.col("p_brand").alias("line")).agg(F.sum("l_extendedprice").alias("v"))
    weights = value.select("fund", "line", (F.col("v") / F.sum("v").over(Window.partitionBy("fund"))).alias("weight"))
    return overlaps(weights, "fund", "line", "weight")


@query(
    "etf_flow_split_guard",
    f"""WITH {PANEL}, l AS (SELECT key, date, close, volume, lag(close) OVER w AS c0, lag(volume) OVER w AS v0 FROM panel WINDOW w AS (PARTITION BY key ORDER BY date))
SELECT key, date, CASE WHEN c0 IS NULL THEN NULL WHEN abs(ln(close / c0)) > 0.2 AND abs(ln(close * volume / (c0 * v0))) < 0.1 THEN NULL ELSE (volume - v0) * close END AS flow FROM l""",
)
def etf_flow_split_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change in units times price, unless a large price move left the total unchanged, which looks like a split."""
    w = by_key()
    rows = panel(spark, sf_dir).select("key", "date", "close", "volume", F.lag("close").over(w).alias("c0"), F.lag("volume").over(w).alias("v0"))
    split = (F.abs(F.ln(F.col("close") / F.col("c0"))) > 0.2) & (F.abs(F.ln(F.col("close") * F.col("volume") / (F.col("c0") * F.col("v0")))) < 0.1)
    return rows.select("key", "date", F.when(F.col("c0").isNotNull() & ~split, (F.col("volume") - F.col("v0")) * F.col("close")).alias("flow"))


@query(
    "par_bond_return",
    f"""WITH {PANEL}, y AS (SELECT key, date, close / 50000 AS y, lag(close / 50000) OVER (PARTITION BY key ORDER BY date) AS p FROM panel)
SELECT key, date, round((CASE WHEN abs(y) < 1e-9 THEN 1 + p * (10 - 1.0 / 12) ELSE p / y + (1 - p / y) * pow(1 + y / 2, -2 * (10 - 1.0 / 12)) END) - 1 + p / 12, 7) AS ret FROM y WHERE p IS NOT NULL""",
)
def par_bond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly return of a ten-year par bond whose yield is a made-up series."""
    rows = panel(spark, sf_dir).select("key", "date", (F.col("close") / 50000).alias("y"))
    rows = rows.withColumn("p", F.lag("y").over(by_key())).where("p is not null")
    return rows.select("key", "date", F.round(par_bond_return(F.col("p"), F.col("y"), 10), 7).alias("ret"))


@query(
    "candidate_rule_cascade",
    r"""SELECT p_partkey, CASE WHEN regexp_matches(p_type, '(?i)promo|economy') THEN 'cheap' WHEN p_size > 45 THEN 'large' WHEN regexp_matches(p_name, '(?i)\b(red|blue)\b') AND NOT regexp_matches(p_type, '(?i)brass') THEN 'coloured' WHEN p_retailprice >= 1800 THEN 'dear' END AS excluded_by,
  coalesce(NOT regexp_matches(p_brand, '#[12]'), false) AS brand_ok, regexp_extract(p_name, '[A-Za-z0-9]+') AS first_word FROM part""",
)
def candidate_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that removes a part; a null check never passes."""
    cascade = (
        F.when(F.col("p_type").rlike("(?i)promo|economy"), "cheap")
        .when(F.col("p_size") > 45, "large")
        .when(F.col("p_name").rlike(r"(?i)\b(red|blue)\b") & ~F.col("p_type").rlike("(?i)brass"), "coloured")
        .when(F.col("p_retailprice") >= 1800, "dear")
    )
    brand_ok = F.coalesce(~F.col("p_brand").rlike("#[12]"), F.lit(False))
    return table(spark, sf_dir, "part").select("p_partkey", cascade.alias("excluded_by"), brand_ok.alias("brand_ok"), F.regexp_extract("p_name", "[A-Za-z0-9]+", 0).alias("first_word"))


@query(
    "publication_lag",
    """WITH s AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) t), o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS settled FROM orders), n AS (
  SELECT o_orderkey, settled, s.i FROM o ASOF LEFT JOIN s ON o.settled < s.date)
SELECT o_orderkey, settled, s.date AS effective FROM n LEFT JOIN s ON s.i = n.i + 7""",
)
def publication_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eighth session after each order's date: sessions know their eighth successor, so one as-of finds it."""
    sessions = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("session")).distinct()
    sessions = sessions.withColumn("effective", F.lead("session", 7).over(Window.orderBy("session")))  # one row a calendar day
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("settled"))
    days = asof_join(orders.select("settled").distinct().withColumn("one", F.lit(1)), sessions.withColumn("one", F.lit(1)), "settled", "session", ["one"], direction="forward", strict=True)
    return orders.join(days.select("settled", "effective"), "settled").select("o_orderkey", "settled", "effective")


@query(
    "universe_flags",
    f"""WITH {PANEL}, w AS (SELECT *, avg(dollar_volume) OVER a AS adv, count(*) OVER a AS days, count(*) OVER b AS bars FROM panel WINDOW a AS (PARTITION BY key ORDER BY date ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), b AS (PARTITION BY key ORDER BY date ROWS UNBOUNDED PRECEDING)), f AS (
  SELECT key, date, s_nationkey < 20 AS pass_place, close >= 1000 AS pass_price, coalesce(adv >= 200000, false) AS pass_adv, days >= 6 AS pass_days, bars >= 12 AS pass_bars FROM w JOIN supplier ON s_suppkey = key)
SELECT *, pass_place AND pass_price AND pass_adv AND pass_days AND pass_bars AS in_universe FROM f""",
)
def universe_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each check of membership, and all of them; liquidity windows end the session before."""
    prior, so_far = trailing(by_key(), 6, 1), by_key().rowsBetween(Window.unboundedPreceding, 0)
    rows = panel(spark, sf_dir).join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("key"))
    flags = {
        "pass_place": F.col("s_nationkey") < 20,
        "pass_price": F.col("close") >= 1000,
        "pass_adv": F.coalesce(F.avg("dollar_volume").over(prior) >= 200000, F.lit(False)),
        "pass_days": F.count("*").over(prior) >= 6,
        "pass_bars": F.count("*").over(so_far) >= 12,
    }
    rows = rows.select("key", "date", *[c.alias(name) for name, c in flags.items()])
    return rows.withColumn("in_universe", F.expr(" and ".join(flags)))
