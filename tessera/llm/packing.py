"""Packing documents into sequences by vector best fit.

Only lengths matter for packing, so the driver packs the histogram of piece lengths (at most ``capacity`` numbers,
whatever the corpus) into patterns with multiplicities; pieces then find their place by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, stage
from .tokens import encoded


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold: tokens, documents, and attention cost (the sum of squared lengths)."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


def need(length: int) -> np.ndarray:
    """What one piece takes of each capacity."""
    return np.array([length, 1, length * length], np.int64)


def best_fit(histogram: dict[int, int], limits: Limits, score: str = "residual", weights: tuple[float, ...] = (1.0, 0.05, 0.05)) -> list[tuple[int, int, int, int, int]]:
    """Packs ``histogram`` (length -> count), longest first, every piece into the best open kind of bin that holds it.

    Bins with equal contents form a kind. ``score``: ``residual`` takes the kind with the smallest weighted norm of what
    would remain (relative to the capacities), ``dot`` the one with the largest weighted dot product of need and
    residual. Returns runs (length, first rank, count, first sequence, offset): the pieces of that length with these
    ranks go to consecutive sequences from the first, each at that offset. Work grows with the kinds, not the pieces.
    """
    if score not in ("residual", "dot"):
        raise ValueError(f"unknown score {score!r}")
    full, w = limits.vector(), np.array(weights)
    room = np.zeros((0, 3), np.int64)
    spans: list[tuple[int, int]] = []
    runs = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank, want = histogram[length], 0, need(length)
        if (want > full).any():
            raise ValueError(f"a piece of {length} tokens fits no empty sequence")
        while left:
            fits = np.flatnonzero((room >= want).all(axis=1))
            if len(fits):
                if score == "residual":
                    value = (w * ((room[fits] - want) / full) ** 2).sum(axis=1)
                else:
                    value = -(w * (want / full) * (room[fits] / full)).sum(axis=1)
                k = int(fits[np.argmin(value)])
                first, n = spans[k]
            else:
                each = int((full // want).min())
                n = -(-left // each)
                k, first = len(spans), opened
                opened += n
                room = np.vstack([room, full])
                spans.append((first, n))
            take = min(left, n)
            runs.append((length, rank, take, first, int(full[0] - room[k, 0])))
            if take < n:
                room = np.vstack([room, room[k]])
                spans.append((first + take, n - take))
            room[k] -= want
            spans[k] = (first, take)
            rank, left = rank + take, left - take
            if len(room) > 4096:
                live = room[:, 0] > 0
                room, spans = room[live], [s for s, ok in zip(spans, live) if ok]
    return runs


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, ids: bool = False) -> DataFrame:
    """Each document's pieces: doc_id, piece, start, length, ids_crc32 (and ids, little-endian 32-bit, if asked for).

    A document is its text's ids and ``end_id``; one longer than ``capacity`` is cut into pieces of that many tokens,
    the first of which may be shorter. Null and empty texts are the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column(0).cast(pa.int64())
            for first, group in encoded(tokenizer, batch.column(1)):
                rows: list[tuple] = []
                for k, raw in enumerate(group, first):
                    raw += last
                    n = len(raw) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        part = raw[4 * a : 4 * b]
                        rows.append((k, piece, a, b - a, zlib.crc32(part), part if ids else None))
                columns = list(zip(*rows))
                arrays = [doc_ids.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:5])]
                arrays += [pa.array(columns[5], pa.binary())] * ids
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + ids])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(cut: DataFrame, limits: Limits = Limits(), score: str = "residual") -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32, slim columns only).

    Every sequence is gapless from offset 0 and within all limits. Sequence numbers are unique, not meaningful. Rows
    with equal values are packed one by one. An empty table gives no rows.
    """
    cut = stage(cut)
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    runs = best_fit(histogram, limits, score)
    spark = cut.sparkSession
    numbered = ranked(cut, ["length"], [F.col("doc_id"), F.col("piece"), F.col("start"), F.col("ids_crc32")])
    found = np.array(runs, np.int64).reshape(-1, 5)
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    shared = spark.sparkContext.broadcast(found)
    step = int(found[:, 1].max()) + 1 if len(found) else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        codes = table[:, 0].astype(object) * step + table[:, 1] if len(table) and int(table[:, 0].max()) * step >= 2**62 else table[:, 0] * step + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(codes, length * step + np.minimum(rank, step - 1), "right") - 1
            hit = table[at]
            arrays = [batch.column(k) for k in range(5)]
            arrays += [pa.array(hit[:, 3] + rank - hit[:, 1], pa.int64()), pa.array(hit[:, 4], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, schema)
