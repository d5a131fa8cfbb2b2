"""Places and running counts over a whole table or large groups, by ranges of the value, so no task holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of like size that a table is cut into; the driver sees one bound less.
RANGES = 64


def range_of(df: DataFrame, value: str, ranges: int = RANGES) -> Column:
    """The number of a value's range, from 0 upwards. Equal values share one; null is in the first."""
    bounds = df.select(F.percentile_approx(value, [k / ranges for k in range(1, ranges)], 100 * ranges)).first()[0]
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b < F.coalesce(F.col(value), b)))


def placed(df: DataFrame, value: str, *ties: str, name: str = "place") -> DataFrame:
    """Adds each row's place, from 1, by rising value and then ``ties``, and ``n``, the number of rows."""
    rows = df.withColumn("_range", range_of(df, value))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_rows"))
    up = Window.orderBy("_range")  # one row a range
    sizes = sizes.select("_range", (F.sum("_rows").over(up) - F.col("_rows")).alias("_before"), F.sum("_rows").over(Window.partitionBy()).alias("n"))
    own = Window.partitionBy("_range").orderBy(value, *ties)
    return rows.join(F.broadcast(sizes), "_range").withColumn(name, F.col("_before") + F.row_number().over(own)).drop("_range", "_before")


def at_least(df: DataFrame, by: list[str], value: str, amount: Column | None = None) -> DataFrame:
    """One row per group and distinct value: at_least, the sum of ``amount`` (rows) with that value or more, and all of the group."""
    counted = df.groupBy(*by, value).agg((F.sum(amount) if amount is not None else F.count("*")).alias("_c"))
    rows = counted.withColumn("_range", range_of(df, value))
    totals = rows.groupBy(*by, "_range").agg(F.sum("_c").alias("_rows"))
    down = Window.partitionBy(*by).orderBy(F.desc("_range"))  # RANGES rows a group
    totals = totals.select(*by, "_range", (F.sum("_rows").over(down) - F.col("_rows")).alias("_above"), F.sum("_rows").over(Window.partitionBy(*by)).alias("all"))
    inside = F.sum("_c").over(Window.partitionBy(*by, "_range").orderBy(F.desc(value)))
    return rows.join(totals, [*by, "_range"]).select(*by, value, (F.col("_above") + inside).alias("at_least"), "all")


def tile(place: Column, n: Column, k: int) -> Column:
    """The k-tile of a place among n: the first tiles are one larger where k does not divide n."""
    size, rest = F.floor(n / k), n % k
    wide = rest * (size + 1)
    return F.when(place <= wide, F.ceil(place / (size + 1))).otherwise(rest + F.ceil((place - wide) / F.greatest(size, F.lit(1)))).cast("int")
