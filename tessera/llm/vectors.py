"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, hot_keys, lookup, partitions, stage
from .hashing import U, mix

#: Vectors of one side of a block.
BLOCK_ROWS = 256


def plan_tables(largest: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits, tables) for groups of up to ``largest`` vectors.

    Bits grow with the logarithm of the group, so buckets of unrelated vectors stay small; tables make a pair at the
    threshold miss all of them with probability ``miss`` at most.
    """
    bits = min(30, max(8, math.ceil(math.log2(max(largest, 2))) + 2))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def sign_keys(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Sign patterns of each vector under ``tables`` sets of ``bits`` random hyperplanes: n x tables."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return (signs << np.arange(bits)).sum(axis=2).astype(np.int64)


def _valid(embedding: str = "embedding") -> Column:
    column = F.col(embedding)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(column.isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column without nulls: row i has values[offsets[i] : offsets[i + 1]]."""
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()


def _keyed(rows: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Adds ``keys``: one bucket number a table, mixed with label and dimension, so only like vectors can meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            values, offsets = _flat(batch.column(2))
            sizes = np.diff(offsets)
            keys = np.zeros((len(sizes), tables), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = values[offsets[at][:, None] + np.arange(size)].astype(np.float64)
                signs = sign_keys(x / np.abs(x).max(axis=1, keepdims=True), bits, tables, seed)
                group = mix(label[at].astype(np.int64).astype(U) * U(0x9E3779B97F4A7C15) + U(int(size)))
                order = np.arange(1, tables + 1, dtype=U) * U(0xD6E8FEB86659FD93)
                keys[at] = mix(signs.astype(U) + group[:, None] + order).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(list(keys), pa.list_(pa.int64()))], names=["rep", "label", "embedding", "weight", "keys"])

    kind = dict(rows.dtypes)["embedding"]
    return rows.mapInArrow(run, f"rep long, label long, embedding {kind}, weight long, keys array<long>")


def _blocks(rows: DataFrame, grid: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Compares the members (bucket, t, rep) of each bucket in blocks; rows (rep, links, root) for every rep of a block.

    A pair counts in the first table in which it meets, so links add up over blocks. ``root`` is the smallest rep that
    links inside the block reach.
    """
    placed = lookup(rows, grid, "bucket").withColumn("own", F.pmod(F.xxhash64("rep"), "ways").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
    placed = placed.select("bucket", "t", "rep", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    full = placed.join(vectors, "rep").repartition(partitions(rows.sparkSession), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "own", "rep")

    def compare(reps: np.ndarray, own: np.ndarray, weight: np.ndarray, x: np.ndarray, keys: np.ndarray, across: bool, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        if len(reps) < 2:
            return None
        x = x.astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        near = (x @ x.T) / (norm[:, None] * norm) >= threshold
        np.fill_diagonal(near, False)
        if across:
            near &= own[:, None] != own
        if not near.any():
            return None
        a, b = np.nonzero(near)
        fresh = ~(keys[a, :t] == keys[b, :t]).any(axis=1)
        links = np.bincount(a[fresh], weights=weight[b[fresh]], minlength=len(reps)).astype(np.int64)
        root = reps.copy()
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            if (low == root).all():
                break
            root = low
        used = np.unique(a)
        return reps[used], links[used], root[used]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []

        def flush() -> list:
            if at is None:
                return []
            reps, own, weight, size, values, keys = (np.concatenate([p[k] for p in parts]) for k in range(6))
            out, starts = [], np.cumsum(size) - size
            for length in np.unique(size):  # one, but for equal hashes of different lengths
                on = np.flatnonzero(size == length)
                out.append(compare(reps[on], own[on], weight[on], values[starts[on][:, None] + np.arange(length)], keys[on], at[1] != at[2], at[3]))
            return out

        for batch in batches:
            found: list = []
            if batch.num_rows:
                bucket, t, rep, own, i, j = (batch.column(k).to_numpy() for k in range(6))
                (values, offsets), weight, (all_keys, key_offsets) = _flat(batch.column(6)), batch.column(7).to_numpy(), _flat(batch.column(8))
                keys = all_keys[key_offsets[0] : key_offsets[-1]].reshape(batch.num_rows, -1)
                new = (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
                edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
                for a, b in zip(edges, edges[1:]):
                    if at is None or (bucket[a], i[a], j[a]) != at[:3]:
                        found += flush()
                        at, parts = (bucket[a], i[a], j[a], t[a]), []
                    parts.append((rep[a:b], own[a:b], weight[a:b], np.diff(offsets[a : b + 1]), values[offsets[a] : offsets[b]], keys[a:b]))
            yield from _result(found)
        yield from _result(flush())

    columns = ["bucket", "t", "rep", "own", "i", "j", "embedding", "weight", "keys"]
    return full.select(*columns).mapInArrow(run, "rep long, links long, root long")


def _result(found: list) -> Iterator[pa.RecordBatch]:
    found = [f for f in found if f]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found]), pa.int64()) for i in range(3)], names=["rep", "links", "root"])


def near_vectors(vectors: DataFrame, threshold: float = 0.98, miss: float = 1e-5, seed: int = 11) -> DataFrame:
    """Links of ``vectors`` (vec_id long, embedding array, label) with equal labels and a cosine of ``threshold`` or more.

    Returns vec_id, n_links, component_id, kept, one row per row. Cosines are exact, in double precision; a pair just at
    the threshold is not found with probability ``miss``. Equal vectors of a label are one vector with a weight, so
    copies are not compared among themselves; they link with each other. Equal rows of one vec_id are one vector, which
    has no link to itself. Labels that are not whole numbers are told apart by a 64-bit hash of their text. Buckets are
    compared in blocks of BLOCK_ROWS rows a side, so a bucket is never in one task.

    Null labels, null, empty or zero vectors and those with null or non-finite components link with nothing, nor do
    vectors of different lengths. Rows with a null vec_id have a null component, no links and are kept. An empty table
    gives no rows.
    """
    kind = dict(vectors.dtypes)["embedding"]
    whole = dict(vectors.dtypes)["label"] in ("tinyint", "smallint", "int", "bigint", "boolean")
    label = F.col("label").cast("long") if whole else F.when(F.col("label").isNotNull(), F.xxhash64(F.col("label").cast("string")))
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", label.alias("label"))
    usable = _valid() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    base = base.withColumn("print", F.when(usable, F.md5(F.concat(F.to_json(F.struct("label")), F.to_json(F.struct("embedding"))))))
    base = stage(base.select("vec_id", "embedding", "label", "print"))
    found = base.where("print is not null")
    each = found.select("print", "vec_id").distinct()
    groups = stage(each.groupBy("print").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "merge")
    named = groups.select(F.col("rep").alias("vec_id"), F.col("print"), "weight")
    own = found.join(named, ["vec_id", "print"]).dropDuplicates(["vec_id", "print"])
    own = own.select(F.col("vec_id").alias("rep"), "label", F.col("embedding").cast(kind), "weight")
    largest = own.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, threshold, miss)
    keyed = stage(_keyed(own, bits, tables, seed))
    spread = keyed.select("rep", F.posexplode("keys").alias("t", "bucket"))
    counted = stage(spread.groupBy("bucket").count().where("count > 1"), "merge")
    pairs_in = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    hot = hot_keys(counted, "bucket", pairs_in)
    members = stage(lookup(spread, counted.select("bucket"), "bucket", hot=hot).select("bucket", "t", "rep"), "merge")
    grid = counted.select("bucket", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("ways"))
    linked = stage(_blocks(members, stage(grid, "merge"), keyed.select("rep", "embedding", "weight", "keys"), threshold), "deal")
    sums = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    facts = groups.join(sums, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    facts = facts.select("print", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    out = lookup(base.select("vec_id", "print"), stage(facts, "merge"), "print", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
