"""Mixing sources to target weights by systematic sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, ranked, stage

#: Words between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float, weights: tuple[float, ...], most: float) -> DataFrame:
    """Adds target to (source, source_size): ``share`` of all sizes split by weight, none above ``most`` times its size.

    Weights go to sources by code point, null last, and repeat. What a stopped source leaves is shared again among the
    others by weight until none is above; the level per unit of weight that this ends at is searched with one small
    aggregate a step. If all stop, targets are ``most`` times the sizes.
    """
    named = ranked(sizes, [], [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rated = stage(named.select("source", "source_size", weight.cast("double").alias("weight"), (F.col("source_size") * most).alias("cap")), "merge")
    total = share * (rated.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        stopped = F.col("cap") < F.col("weight") * level
        used, free = rated.agg(F.sum(F.when(stopped, F.col("cap")).otherwise(0.0)), F.sum(F.when(stopped, 0.0).otherwise(F.col("weight")))).first()
        above = (total - used) / free if free else float("inf")
        if above <= level * (1 + 1e-12):
            break
        level = above
    return rated.withColumn("target", F.least("cap", F.col("weight") * level)).select("source", "source_size", "target")


def _offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by source and seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32


def copies(docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (5, 2, 1), most: float = 2.0, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """How often the mix takes each row of ``docs`` (doc_id, text, source).

    Returns doc_id, size (words), source_size, target, copies, taken (size * copies), and the columns in ``keep`` as a
    struct ``_row``. Every row of a source expects target / source_size copies, ``most`` at most. Rows are ordered by
    size, then doc_id; their expected copies are summed up, a fixed random offset of the source is added, and a row is
    taken once per integer that its own share of the sum crosses. So neighbours of like size stand in for each other and
    a source's words miss the target by about one long document at most.

    Null and empty texts have size 0. Sources without any words are not taken. Equal rows are rows of their own. Reruns
    agree: ranks follow from values, the offset from source and seed. No source is held by one task.
    """
    slim = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *([F.struct(*keep).alias("_row")] if keep else []))
    if not keep:
        slim = stage(slim)
    order = [F.col("size"), F.col("doc_id")] + ([F.xxhash64("_row")] if keep else [])
    placed = ranked(slim, ["source"], order)
    if keep:
        sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    else:
        sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = targets(sizes, share, weights, most)
    tag = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    facts = named.select(tag.alias("_tag"), "source_size", "target", _offset(F.col("source"), seed).alias("_offset"))
    both = lookup(placed.withColumn("_tag", tag), stage(facts, "merge"), "_tag")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = F.floor((F.col("rank") + 1) * each + F.col("_offset")) - F.floor(F.col("rank") * each + F.col("_offset"))
    out = both.withColumn("copies", crossed.cast("int"))
    columns = ["doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")]
    return out.select(*columns, *(["_row"] if keep else []))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, each as often as it is taken."""
    found = copies(docs, keep=docs.columns, **options).where("copies > 0")
    return found.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")
