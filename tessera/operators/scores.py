"""Rarity scores: moves over their own volatility, calibrated to normal quantiles within a family's pool."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import two_sided_z
from .ranges import at_least


def move_z(moves: DataFrame, horizons: list[int], half_life: float = 15, window: int = 252, least: int = 63) -> DataFrame:
    """z of the move over each horizon: rows (family, subject, h, date, elig, z_raw) from (family, subject, date, x, min_sd, elig).

    Volatility is an exponentially weighted RMS of at most ``window`` earlier moves, floored at min_sd.
    """
    lam = 0.5 ** (1.0 / half_life)
    own = Window.partitionBy("family", "subject").orderBy("date")
    rows = moves.withColumn("i", F.row_number().over(own))
    before = own.rowsBetween(-window, -1)
    seen = F.count("x").over(before)
    raw = F.sqrt(F.sum(F.col("x") * F.col("x") * F.pow(F.lit(lam), -F.col("i"))).over(before) * F.pow(F.lit(lam), F.col("i") - 1) * (1 - lam) / (1 - F.pow(F.lit(lam), seen)))
    rows = rows.withColumn("sd_raw", F.when(seen >= least, raw)).withColumn("sd", F.when(F.col("sd_raw").isNotNull(), F.greatest("sd_raw", "min_sd")))
    parts = []
    for h in horizons:
        frame = own.rowsBetween(-(h - 1), 0)
        z = F.when(F.count("x").over(frame) == h, F.try_divide(F.sum("x").over(frame), F.col("sd") * h**0.5))
        parts.append(F.struct(F.lit(h).alias("h"), z.alias("z_raw")))
    wide = rows.select("family", "subject", "date", "elig", F.array(*parts).alias("parts"))
    return wide.select("family", "subject", "date", "elig", F.inline("parts")).select("family", "subject", "h", "date", "elig", "z_raw")


def calibrated(raw: DataFrame) -> DataFrame:
    """Adds z: the normal quantile as rare as \\|z_raw\\| is in the pool of its family and horizon (rows with elig only)."""
    pool = raw.where("elig and z_raw is not null and not isnan(z_raw)").withColumn("size", F.abs("z_raw"))
    counts = at_least(pool, ["family", "h"], "size")
    q = (F.col("at_least") - 0.5) / F.col("all")
    return pool.join(counts, ["family", "h", "size"]).withColumn("q", q).select("family", "subject", "h", "date", "z_raw", (F.signum("z_raw") * two_sided_z(F.col("q"))).alias("z"))
