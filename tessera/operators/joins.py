"""Joins on time (as-of, spans, trailing ranges) and overlaps of all pairs of a set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Spans up to this size are broadcast; larger ones meet by key.
BROADCAST_BYTES = 32 << 20
#: Keys and weights in a block of ``overlaps``, about, and keys of one block compared at a time.
BLOCK_KEYS, BLOCK_ROWS, STRIP = 2048, 200_000, 256


def small(df: DataFrame) -> bool:
    """Whether the optimizer's estimate of a table is below BROADCAST_BYTES."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= BROADCAST_BYTES


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    by: list[str],
    direction: str = "backward",
    strict: bool = False,
    how: str = "left",
    tolerance: int | None = None,
) -> DataFrame:
    """Each left row with the newest right row at or before its time (``forward``: the oldest at or after).

    ``strict`` leaves out equal times, ``how`` is left or inner, ``tolerance`` is the most days between both times and is
    applied after the match, so a stale match is no match. Right rows must be unique per (by, time). Both sides are
    unioned and one window over ``by`` carries the right row along: one shuffle, no pairs.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, how is left or inner")
    backward = direction == "backward"
    carried = [c for c in right.columns if c not in by]
    keys = [F.col(k) for k in by]
    # At equal times the right row must be met first, unless strict.
    first = 1 if strict else 0
    lefts = left.select(*keys, F.col(left_time).alias("_time"), F.lit(1 - first).alias("_side"), F.struct(*left.columns).alias("_left"), F.lit(None).cast(right.select(F.struct(*carried)).schema[0].dataType).alias("_right"))
    rights = right.select(*keys, F.col(right_time).alias("_time"), F.lit(first).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_left"), F.struct(*carried).alias("_right"))
    time = F.col("_time").asc() if backward else F.col("_time").desc()
    w = Window.partitionBy(*by).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = lefts.unionByName(rights).withColumn("_match", F.last("_right", ignorenulls=True).over(w)).where("_left is not null")
    if tolerance is not None:
        gap = F.abs(F.datediff(F.col(f"_match.{right_time}"), F.col(f"_left.{left_time}")))
        met = met.withColumn("_match", F.when(gap <= tolerance, F.col("_match")))
    if how == "inner":
        met = met.where("_match is not null")
    clash = set(left.columns)
    return met.select("_left.*", *[F.col(f"_match.{c}").alias(f"{c}_right" if c in clash else c) for c in carried])


def spans(events: DataFrame, by: list[str], start: str, end: str = "span_end") -> DataFrame:
    """Events as half-open spans [start, next start) within ``by``; the last one has a null end."""
    return events.withColumn(end, F.lead(start).over(Window.partitionBy(*by).orderBy(start)))


def span_join(left: DataFrame, events: DataFrame, by: list[str], time: str, start: str, how: str = "left") -> DataFrame:
    """Left rows with the event whose span holds their time: an equi and range join, the spans broadcast if small."""
    pieces = spans(events, by, start)
    other = pieces.select(*[F.col(c).alias(f"_{c}") for c in pieces.columns])
    inside = (F.col(time) >= F.col(f"_{start}")) & (F.col("_span_end").isNull() | (F.col(time) < F.col("_span_end")))
    on: Column = inside
    for k in by:
        on = on & (F.col(k) == F.col(f"_{k}"))
    joined = left.join(F.broadcast(other) if small(events) else other, on, how)
    keep = [F.col(f"_{c}").alias(c if c not in left.columns else f"{c}_right") for c in events.columns if c not in by]
    return joined.select(*left.columns, *keep)


def trailing_sum(left: DataFrame, events: DataFrame, by: list[str], time: str, event_time: str, value: str, days: int, name: str) -> DataFrame:
    """Adds the sum of event values in (time - days, time] to each left row, 0 without any.

    Both sides are unioned and one RANGE window sums them up, so nothing is paired and events of a key never multiply.
    """
    keys = [F.col(k) for k in by]
    rows = left.select(*keys, F.col(time).alias("_time"), F.struct(*left.columns).alias("_left"), F.lit(None).cast("double").alias("_value"))
    rows = rows.unionByName(events.select(*keys, F.col(event_time).alias("_time"), F.lit(None).cast(rows.schema["_left"].dataType).alias("_left"), F.col(value).cast("double").alias("_value")))
    day = F.unix_date(F.col("_time").cast("date"))
    w = Window.partitionBy(*by).orderBy(day).rangeBetween(-(days - 1), 0)
    summed = rows.withColumn(name, F.coalesce(F.sum("_value").over(w), F.lit(0.0)))
    return summed.where("_left is not null").select("_left.*", name)


def _block_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, overlap of the pairs of keys of two blocks (left, right: item, keys, weights), or of one block with itself."""

    def side(items: pa.StructArray) -> tuple[np.ndarray, dict]:
        keys, weights = items.field("keys"), items.field("weights")
        own = np.unique(keys.flatten().to_numpy(zero_copy_only=False))
        parts = zip(items.field("item").to_pylist(), keys, weights)
        found = {}
        for item, k, w in parts:
            at = np.searchsorted(own, k.values.to_numpy())
            order = np.argsort(at)
            found[item] = at[order], w.values.to_numpy(zero_copy_only=False).astype(float)[order]
        return own, found

    for batch in batches:
        for same, left, right in zip(batch["same"].to_pylist(), batch["left"], batch["right"]):
            a, of_a = side(left.values)
            b, of_b = (a, of_a) if same else side(right.values)
            both = [(*of_a[item], *of_b[item]) for item in of_a if item in of_b]
            for start in range(0, len(a), STRIP):
                n = min(STRIP, len(a) - start)
                total, met, known = np.zeros((n, len(b))), np.zeros((n, len(b)), bool), np.zeros((n, len(b)), bool)
                for i, x, j, y in both:
                    here = (i >= start) & (i < start + n)
                    if not here.any():
                        continue
                    least = np.fmin.outer(x[here], y)
                    rows, columns = i[here] - start, j
                    at = ... if len(rows) == n and len(columns) == len(b) else np.ix_(rows, columns)
                    total[at] += np.nan_to_num(least, nan=0.0)
                    met[at] = True
                    known[at] |= ~np.isnan(least)
                i, j = np.nonzero(met & (a[start : start + n, None] < b[None, :]) if same else met)
                x, y, value = a[start + i], b[j], total[i, j] * 1e6
                value = np.trunc(value + np.copysign(0.5, value)) / 1e6
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(value, mask=~known[i, j])], ["a", "b", "overlap"])


def overlaps(weights: DataFrame, key: str, item: str, weight: str) -> DataFrame:
    """a, b, overlap for each two keys a < b (longs) that share an item: the sum over shared items of the smaller weight, to 6 digits.

    ``weights`` has a (key, item) once. Keys are dealt to blocks and each two blocks meet once, so what is shuffled are the
    weights, once a block; pairs are summed where they meet and go straight to the result. The smaller of a null and a
    number is the number.
    """
    known = weights.select(F.col(key).cast("long").alias("key"), F.col(item).alias("item"), F.col(weight).cast("double").alias("weight")).where("key is not null and item is not null")
    n_keys, n_rows = known.agg(F.count_distinct("key"), F.count("*")).first()
    blocks = max(1, -(-n_keys // BLOCK_KEYS), -(-n_rows // BLOCK_ROWS))
    dealt = known.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    lists = dealt.groupBy("block", "item").agg(F.collect_list(F.struct("key", "weight")).alias("rows"))
    lists = lists.groupBy("block").agg(F.collect_list(F.struct("item", F.col("rows.key").alias("keys"), F.col("rows.weight").alias("weights"))).alias("items"))
    pairs = lists.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    first = F.col("block") <= F.col("other")
    pairs = pairs.groupBy(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    pairs = pairs.agg(F.first(F.when(first, F.col("items")), ignorenulls=True).alias("left"), F.first(F.when(F.col("block") >= F.col("other"), F.col("items")), ignorenulls=True).alias("right"))
    pairs = pairs.where("left is not null and right is not null").select((F.col("i") == F.col("j")).alias("same"), "left", "right")
    return pairs.mapInArrow(_block_overlaps, "a long, b long, overlap double")
