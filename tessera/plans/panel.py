"""Panels that stand for securities and sessions: suppliers (dense) and parts (sparse) by month, users by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import ordered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str, key: str = "l_suppkey") -> DataFrame:
    """One row per key and month: key, date, close, volume, dollar_volume, n_lines."""
    lines = table(spark, sf_dir, "lineitem")
    month = F.trunc("l_shipdate", "month").alias("date")
    value, volume = F.sum("l_extendedprice"), F.sum("l_quantity")
    grouped = lines.groupBy(F.col(key).cast("long").alias("key"), month)
    return grouped.agg((F.round(value, 2) / F.round(volume, 2)).alias("close"), F.round(volume, 2).alias("volume"), F.round(value, 2).alias("dollar_volume"), F.count("*").alias("n_lines"))


def returns(spark: SparkSession, sf_dir: str, key: str = "l_suppkey") -> DataFrame:
    """The panel with ret, the change of close since the key's previous row, and i, the row's place."""
    w = ordered(["key"], "date")
    rows = panel(spark, sf_dir, key)
    return rows.withColumn("ret", F.round(F.try_divide("close", F.lag("close").over(w)) - 1, 9)).withColumn("i", F.row_number().over(w))


def panel_sql(key: str = "l_suppkey") -> str:
    return f"""panel AS (
  SELECT CAST({key} AS BIGINT) AS key, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         round(sum(l_extendedprice), 2) / round(sum(l_quantity), 2) AS close, round(sum(l_quantity), 2) AS volume,
         round(sum(l_extendedprice), 2) AS dollar_volume, count(*) AS n_lines
  FROM lineitem GROUP BY 1, 2)"""


def returns_sql(key: str = "l_suppkey") -> str:
    return f"""{panel_sql(key)}, rets AS (
  SELECT *, round(close / lag(close) OVER (PARTITION BY key ORDER BY date) - 1, 9) AS ret,
         row_number() OVER (PARTITION BY key ORDER BY date) AS i FROM panel)"""


PANEL, RETS = panel_sql(), returns_sql()
