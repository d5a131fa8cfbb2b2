"""Window building blocks: trailing frames, average ranks, fills, islands, weighted volatility, compounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def ordered(by: list[str], *order: str) -> WindowSpec:
    """Rows of ``by`` in order, nulls last."""
    return Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def trailing(w: WindowSpec, n: int, last: int = 0) -> WindowSpec:
    """The n rows that end ``last`` rows before the current one."""
    return w.rowsBetween(-(n - 1) - last, -last)


def enough(value: Column, seen: Column, least: int) -> Column:
    """The value, null until ``least`` observations are seen."""
    return F.when(seen >= least, value)


def average_rank(by: list[str], value: str) -> Column:
    """Rank from 1 with ties at their mean; null values come last."""
    order = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
    ties = F.count(F.lit(1)).over(order.rangeBetween(Window.unboundedPreceding, 0))
    return (F.rank().over(order) + ties) / 2


def bucket(rank: Column, n: Column, k: int) -> Column:
    """The k-quantile bucket, from 1, of an average rank among n."""
    return F.ceil(rank * k / n).cast("int")


def filled(value: str | Column, w: WindowSpec) -> Column:
    """The last known value up to the current row."""
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def island(changed: Column, w: WindowSpec) -> Column:
    """A running number of runs: grows by one on every row that starts a new one."""
    return F.sum(F.coalesce(changed, F.lit(True)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))


def compounded(ret: str | Column, w: WindowSpec) -> Column:
    """The product of 1 + returns over a frame, less 1."""
    value = F.col(ret) if isinstance(ret, str) else ret
    return F.exp(F.sum(F.ln(1 + value)).over(w)) - 1


def ew_rms(x: Column, position: Column, before: WindowSpec, half_life: float, least: int) -> Column:
    """Exponentially weighted RMS of a key's earlier values, null until ``least`` of them.

    ``position`` counts rows from 1 and ``before`` frames all earlier rows. Two running sums do it in one pass; weights
    overflow after about 1,000 half-lives, so longer histories need a bounded frame.
    """
    if half_life < 2:
        raise ValueError("the half-life must be 2 or more")
    decay = F.lit(0.5 ** (1.0 / half_life))
    total = F.sum(x * x * F.pow(decay, -position)).over(before)
    scale = F.pow(decay, position - 1) * (1 - decay) / (1 - F.pow(decay, position - 1))
    return F.when(position - 1 >= least, F.sqrt(total * scale))


def safe_corr(x: Column, y: Column) -> Column:
    """Correlation of pairs, null if either side is constant. An aggregate; never divides by zero, also in ANSI mode."""
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def rolling_corr(x: str, y: str, w: WindowSpec, least: int) -> Column:
    """Correlation over a frame of the rows that have both; null below ``least`` pairs or if either side is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    spread = F.sqrt(F.var_pop(a).over(w) * F.var_pop(b).over(w))
    return F.when(F.count(a).over(w) >= least, F.try_divide(F.covar_pop(a, b).over(w), spread))


def newest(df: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """The first row of each group in the given order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_k(df: DataFrame, by: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each group, with their place."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
