"""Robust statistics per group: weighted medians and clipping around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .regress import MAD_TO_SD


def weighted_median(df: DataFrame, by: list[str], value: str, weight: str, name: str) -> DataFrame:
    """One row per group: the smallest value with at least half the weight at or below it. Nulls are left out."""
    rows = df.where(F.col(value).isNotNull() & F.col(weight).isNotNull())
    order = Window.partitionBy(*by).orderBy(value).rangeBetween(Window.unboundedPreceding, 0)
    below, total = F.sum(weight).over(order), F.sum(weight).over(Window.partitionBy(*by))
    return rows.withColumn("_hit", below >= 0.5 * total).where("_hit").groupBy(*by).agg(F.min(value).alias(name))


def clipped(df: DataFrame, by: list[str], value: str, weight: str, k: float, name: str) -> DataFrame:
    """Adds the value clipped at its group's weighted median plus or minus k robust deviations; unchanged without spread."""
    middle = weighted_median(df, by, value, weight, "_med")
    away = df.join(middle, by, "left").withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    spread = weighted_median(away, by, "_dev", weight, "_mad")
    rows = away.join(spread, by, "left")
    reach = k * MAD_TO_SD * F.col("_mad")
    inside = F.least(F.greatest(F.col(value), F.col("_med") - reach), F.col("_med") + reach)
    out = F.when(F.col(value).isNotNull(), F.when(reach > 0, inside).otherwise(F.col(value)))
    return rows.withColumn(name, out).select(*df.columns, name)
