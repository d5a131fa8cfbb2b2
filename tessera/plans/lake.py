"""Lake operators on the test tables: range scans, folds of pulls, gaps, audits, restatements, schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.lake import Dataset, Lake, event_keys, newest_pull, restatement
from ..operators.windows import ordered
from .panel import PANEL, panel, table
from .registry import query

SCAN = "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01'"


@query("scan_partition_range", SCAN)
def scan_partition_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days, pushed down to the scan."""
    lines = table(spark, sf_dir, "lineitem").where("l_shipdate >= timestamp '1997-03-01' and l_shipdate < timestamp '1997-04-01'")
    return lines.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")


@query("optional_source_empty", "SELECT CAST(NULL AS BIGINT) AS key, CAST(NULL AS DOUBLE) AS value WHERE false")
def optional_source_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without files, read through the lake: an empty table with its types."""
    kind = T.StructType().add("key", T.LongType()).add("value", T.DoubleType())
    return Lake(spark, f"{sf_dir}/not-published").register(Dataset("optional", key=None, schema=kind)).read("optional")


PULLS = "pulls AS (SELECT l_partkey AS key, CAST(date_trunc('year', l_shipdate) AS DATE) AS pulled, CASE WHEN (l_partkey + year(l_shipdate)) % 3 <> 0 THEN max(l_quantity) END AS value FROM lineitem GROUP BY 1, 2, (l_partkey + year(l_shipdate)) % 3)"


def pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("key"), F.trunc("l_shipdate", "year").alias("pulled")).agg(F.max("l_quantity").alias("value"))
    return lines.withColumn("value", F.when((F.col("key") + F.year("pulled")) % 3 != 0, F.col("value")))


@query("current_state_fold", f"WITH {PULLS} SELECT key, arg_max(value, pulled) AS value, max(pulled) AS pulled FROM pulls WHERE value IS NOT NULL GROUP BY 1")
def current_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key's value from the newest pull that has one."""
    return newest_pull(pulls(spark, sf_dir), ["key"], "value", "pulled")


@query(
    "gaps_calendar",
    f"""WITH {PANEL.replace("l_suppkey", "l_partkey")}, cal AS (SELECT DISTINCT date FROM panel), keys AS (SELECT key, min(date) AS a, max(date) AS b FROM panel GROUP BY 1)
SELECT key, cal.date FROM keys JOIN cal ON cal.date BETWEEN a AND b ANTI JOIN panel ON panel.key = keys.key AND panel.date = cal.date""",
)
def gaps_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions between a key's first and last row on which it has none: the months between neighbours, kept if sessions."""
    rows = panel(spark, sf_dir, "l_partkey").select("key", "date")
    calendar = rows.select("date").distinct()
    after = F.lead("date").over(ordered(["key"], "date"))
    holes = rows.withColumn("after", after).where(F.col("after") > F.add_months("date", 1))
    holes = holes.select("key", F.explode(F.sequence(F.add_months("date", 1), F.add_months("after", -1), F.expr("interval 1 month"))).alias("date"))
    return holes.join(calendar, "date", "left_semi").select("key", "date")


@query(
    "newest_copy_dedup",
    "WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM r WHERE n = 1",
)
def newest_copy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last copy of each key without a sort: one aggregate over structs."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    best = orders.groupBy("o_custkey").agg(F.max_by(F.struct(*orders.columns), F.struct("o_orderdate", "o_orderkey")).alias("r"))
    return best.select("r.*")


@query(
    "schema_evolution_read",
    "SELECT o_orderkey AS key, o_totalprice AS price, CAST(NULL AS VARCHAR) AS status FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' UNION ALL BY NAME SELECT o_orderstatus AS status, o_orderkey AS key, o_totalprice AS price FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
)
def schema_evolution_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that lack a later column are united by name; the column is null there."""
    orders = table(spark, sf_dir, "orders")
    old = orders.where("o_orderdate < timestamp '1998-01-01'").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    new = orders.where("o_orderdate >= timestamp '1998-01-01'").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    return old.unionByName(new, allowMissingColumns=True)


@query(
    "audit_bars",
    f"""WITH {PANEL} SELECT date, count(*) AS n, count(*) FILTER (WHERE NOT coalesce(close > 0, false)) AS bad_price, count(*) FILTER (WHERE NOT coalesce(volume >= 50, false)) AS thin,
  count(*) <> count(DISTINCT key) AS repeated, count(*) >= 90 AS enough FROM panel GROUP BY 1""",
)
def audit_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of the rules for a session's rows, in one scan; a null fails a rule."""
    bad = lambda c: F.count_if(~F.coalesce(c, F.lit(False)))
    return panel(spark, sf_dir).groupBy("date").agg(
        F.count("*").alias("n"),
        bad(F.col("close") > 0).alias("bad_price"),
        bad(F.col("volume") >= 50).alias("thin"),
        (F.count("*") != F.countDistinct("key")).alias("repeated"),
        (F.count("*") >= 90).alias("enough"),
    )


def two_pulls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two pulls of made-up factors: the newer lacks some events, has others, and restates a few."""
    base = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).alias("key"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderkey") % 97 / 10.0).alias("factor"), "o_orderkey")
    factor = F.when(F.col("o_orderkey") % 11 != 0, F.col("factor"))
    old = base.where("o_orderkey % 5 <> 0").select("key", "day", factor.alias("factor"))
    changed = F.when(F.col("o_orderkey") % 7 == 0, factor * 1.5).otherwise(factor)
    new = base.where("o_orderkey % 6 <> 0").select("key", "day", changed.alias("factor"))
    return old, new


TWO = """base AS (SELECT o_custkey % 200 AS key, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 97 / 10.0 END AS factor, o_orderkey FROM orders), old AS (SELECT key, day, factor FROM base WHERE o_orderkey % 5 <> 0), new AS (
  SELECT key, day, CASE WHEN o_orderkey % 7 = 0 THEN factor * 1.5 ELSE factor END AS factor FROM base WHERE o_orderkey % 6 <> 0), ok AS (
  SELECT key, day, count(DISTINCT factor) <= 1 AND count(factor) IN (0, count(*)) AS agree, min(factor) AS f FROM old GROUP BY 1, 2), nk AS (
  SELECT key, day, count(DISTINCT factor) <= 1 AND count(factor) IN (0, count(*)) AS agree, min(factor) AS f FROM new GROUP BY 1, 2)"""


@query(
    "restatement_diff",
    f"""WITH {TWO} SELECT (SELECT count(*) FROM nk ANTI JOIN ok USING (key, day)) AS added, (SELECT count(*) FROM ok ANTI JOIN nk USING (key, day)) AS removed,
  (SELECT count(*) FROM ok JOIN nk USING (key, day) WHERE ok.agree AND nk.agree AND ok.f IS DISTINCT FROM nk.f) AS restated, (SELECT count(*) FROM ok WHERE NOT agree) AS old_disagree, (SELECT count(*) FROM nk WHERE NOT agree) AS new_disagree,
  (SELECT round(max(abs(nk.f - ok.f) / nullif(abs(ok.f), 0)), 6) FROM ok JOIN nk USING (key, day) WHERE ok.agree AND nk.agree AND ok.f IS DISTINCT FROM nk.f) AS largest,
  (SELECT count(*) FROM ok JOIN nk USING (key, day) WHERE ok.agree AND nk.agree AND (ok.f IS NULL) <> (nk.f IS NULL)) AS null_changes""",
)
def restatement_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = two_pulls(spark, sf_dir)
    return restatement(old, new, ["key", "day"], "factor").withColumn("largest", F.round("largest", 6))


@query(
    "restatement_drift",
    f"""WITH {TWO}, j AS (SELECT year(day) AS year, nk.f / nullif(ok.f, 0) AS ratio FROM ok JOIN nk USING (key, day) WHERE ok.agree AND nk.agree AND ok.f IS NOT NULL AND nk.f IS NOT NULL)
SELECT year, count(ratio) AS n, round(median(ratio), 6) AS middle, count(*) FILTER (WHERE abs(ratio - 1) > 0.01) AS moved FROM j GROUP BY 1""",
)
def restatement_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How events that both pulls state moved, by year."""
    old, new = (event_keys(p, ["key", "day"], "factor").where("agree and f is not null") for p in two_pulls(spark, sf_dir))
    ratio = F.col("g") / F.nullif(F.col("f"), F.lit(0.0))
    both = old.select("key", "day", "f").join(new.select("key", "day", F.col("f").alias("g")), ["key", "day"]).select(F.year("day").cast("long").alias("year"), ratio.alias("ratio"))
    return both.groupBy("year").agg(F.count("ratio").alias("n"), F.round(F.median("ratio"), 6).alias("middle"), F.count_if(F.abs(F.col("ratio") - 1) > 0.01).alias("moved"))


@query(
    "source_freshness",
    "SELECT 'orders' AS source, count(*) AS n, max(CAST(o_orderdate AS DATE)) AS newest, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders UNION ALL SELECT 'lineitem', count(*), max(CAST(l_shipdate AS DATE)), count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem UNION ALL SELECT 'events', count(*), max(CAST(ts AS DATE)), count(DISTINCT CAST(ts AS DATE)) FROM events",
)
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")):
        day = F.col(column).cast("date")
        parts.append(table(spark, sf_dir, name).agg(F.lit(name).alias("source"), F.count("*").alias("n"), F.max(day).alias("newest"), F.countDistinct(day).alias("days")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
