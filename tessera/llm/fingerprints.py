"""Document fingerprints by winnowing: the rightmost smallest hash of every window of k-gram hashes, with its position."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, range_bounds, range_number
from .hashing import U, mix, powers

#: Low bits of a window key, which hold the position, so that of equal hashes the rightmost is the smallest key.
_LOW = 24
_MASK = U((1 << _LOW) - 1)
_VALUES = mix(np.arange(1, 65537, dtype=U) * U(0xC2B2AE3D27D4EB4F))


def kgram_hashes(text: str, k: int) -> np.ndarray:
    """Rolling hashes of all k-grams of code points; a shorter text is one gram, an empty one none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(points)
    if not n:
        return np.empty(0, U)
    k = min(k, n)
    values = _VALUES[points] if int(points.max()) < 65536 else mix((points.astype(U) + U(1)) * U(0xC2B2AE3D27D4EB4F))
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(values * down[:n], out=total[1:])
    return mix((total[k:] - total[: n - k + 1]) * up[: n - k + 1] + U(k))


def winnow(text: str, k: int = 16, window: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of 40 bits, positions) that winnowing keeps, by position.

    Of each ``window`` consecutive k-grams the smallest hash is kept, the rightmost of equal ones. So two texts that
    share ``k + window - 1`` code points in a row share a kept hash. Fewer grams than a window are one window.
    """
    keys = kgram_hashes(text, k)
    n = len(keys)
    if not n:
        return np.empty(0, U), np.empty(0, np.int64)
    place = np.arange(n, dtype=U) & _MASK
    keys = (keys & ~_MASK) | (_MASK - place)
    width = min(window, n)
    least, have = keys, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: n - width + 1], least[width - have : width - have + n - width + 1])
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    at = np.flatnonzero(new)
    kept = least[at]
    behind = ((_MASK - (kept & _MASK)).astype(np.int64) - at) & int(_MASK)
    return kept >> U(_LOW), at + behind


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """A fingerprint as text: how many hashes it keeps and 128 bits over them and their positions."""
    both = hashes * U(0xFF51AFD7ED558CCD) + positions.astype(U)
    order = np.arange(1, len(both) + 1, dtype=U)
    a, b = (int(np.sum(mix(both ^ (order * s)), dtype=U)) for s in (U(0x9E3779B97F4A7C15), U(0xC4CEB9FE1A85EC53)))
    return f"{len(both):x}-{a:016x}{b:016x}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted distinct hash sets; two empty ones are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    place = np.searchsorted(a, b)
    place[place == len(a)] = 0
    shared = int((a[place] == b).sum())
    return shared / (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, k: int = 16, window: int = 16) -> DataFrame:
    """Each document's kept hashes and positions: doc_id, hashes array<long>, positions array<long>. Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                kept = [winnow(t or "", k, window) for t in part.column(1).to_pylist()]
                hashes, positions = (pa.array([x[i].astype(np.int64) for x in kept], pa.list_(pa.int64())) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), hashes, positions], names=["doc_id", "hashes", "positions"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


_LEAST = -(2**63)


def with_next(docs: DataFrame) -> DataFrame:
    """Deals documents by falling doc_id so that each partition also has the row that follows its last one.

    Columns doc_id, text, shard, ghost; a ghost row is there for its predecessor only. Within a partition rows go by
    shard, ghost, falling doc_id (nulls last), text. The texts are shuffled once; the driver sees one doc_id a partition.
    """
    n = partitions(docs.sparkSession)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("key"), "text")
    bounds = range_bounds(keyed.select("key"), "key", n)
    numbered = keyed.withColumn("shard", range_number(bounds, "key"))
    heads = dict(sorted(tuple(r) for r in numbered.groupBy("shard").agg(F.max("key")).collect()))
    order = list(heads)
    to = {heads[s]: order[(i + 1) % len(order)] for i, s in enumerate(order)}
    ids = sorted(to)
    known, where = np.array(ids, np.int64), np.array([to[i] for i in ids], np.int32)

    @F.pandas_udf("int")
    def ghost_of(keys: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return pd.Series(np.where(known[at] == keys, where[at], -1))

    if not order:
        numbered = numbered.withColumn("ghosts", F.lit(-1))
    else:
        numbered = numbered.withColumn("ghosts", ghost_of("key"))
    own = F.struct(F.col("shard"), F.lit(0).alias("ghost"))
    also = F.struct(F.col("ghosts").alias("shard"), F.lit(1).alias("ghost"))
    rows = numbered.select("key", "text", F.explode(F.when(F.col("ghosts") < 0, F.array(own)).otherwise(F.array(own, also))).alias("to"))
    rows = rows.select("key", "text", "to.shard", "to.ghost")
    return rows.repartitionById(n, F.col("shard")).sortWithinPartitions("shard", "ghost", F.desc("key"), "text")


def compared(docs: DataFrame, k: int = 16, window: int = 16) -> DataFrame:
    """Fingerprints of each text and of its edited text, with likenesses: see the returned schema below.

    The edited text has its last half (rounded down) replaced by as many code points from the start of the next document
    by falling doc_id, or all of them; after the last document comes the first. Equal doc_ids go by text, null ones
    last; null texts are empty. A single document is its own next. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            out: list[tuple] = []
            keys, shards, ghosts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for key, cell, shard, ghost in zip(keys, batch.column(1), shards, ghosts):
                if before and before[0] != shard:
                    before = None
                if ghost and not before:
                    continue
                text = cell.as_py() or ""
                hashes, positions = winnow(text, k, window)
                own = np.unique(hashes)
                if before:
                    _, doc, last, print_, known = before
                    half = len(last) // 2
                    edited = last[: len(last) - half] + text[:half]
                    changed = winnow(edited, k, window)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((doc, len(last), sha, print_, digest(*changed), likeness(known, np.unique(changed[0])), likeness(known, own)))
                before = None if ghost else (shard, None if key == _LEAST else key, text, digest(hashes, positions), own)
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(run, schema)
