"""Reshaping and chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_known(df: DataFrame, ids: list[str], values: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """Wide to long, without the rows whose value is null."""
    return df.unpivot(ids, values, name, value).where(F.col(value).isNotNull())


def pivot_first(df: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Long to wide for a fixed list of names; the first known value of each cell."""
    cells = [F.first(F.when(F.col(name) == n, F.col(value)), ignorenulls=True).alias(n) for n in names]
    return df.groupBy(key).agg(*cells)


def chain_roots(links: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """The first member of each chain of links: (member, root, steps). Members of a cycle have no root and drop out.

    Each round doubles the distance that a pointer spans, so a chain of n links takes log2(n) joins.
    """
    firsts = links.select(F.col(old).alias("member")).join(links.select(F.col(new).alias("member")), "member", "left_anti").distinct()
    hop = links.select(F.col(new).alias("member"), F.col(old).alias("to"), F.lit(1).cast("long").alias("steps"))
    while True:
        far = hop.select(F.col("member").alias("to"), F.col("to").alias("further"), F.col("steps").alias("more"))
        joined = hop.join(far, "to", "left")
        moved = joined.where("further is not null and further <> member")
        if not moved.limit(1).count() or hop.agg(F.max("steps")).first()[0] > links.count():
            break
        hop = joined.select("member", F.coalesce("further", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")).checkpoint()
    reached = hop.select("member", F.col("to").alias("root"), "steps")
    return reached.join(firsts.select(F.col("member").alias("root")), "root", "left_semi").select("member", "root", "steps")
