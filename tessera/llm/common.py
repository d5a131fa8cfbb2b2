"""Plumbing shared by the corpus operators: staged tables, skew-safe lookups, distributed ranks and connected components.

Nothing here collects data that grows with the corpus: the driver sees counts and at most ``HOT_KEYS`` keys.
"""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot if it holds more than 1/HOT_KEYS of a table's rows, so there are never more than HOT_KEYS hot keys.
HOT_KEYS = 1000
#: Keys with fewer rows than this are never hot.
LEAST_HOT = 200
#: Threads of each of the driver's pools that run exchanges.
POOL_THREADS = 32
#: Tables that the optimizer takes to be no larger than this are broadcast, which needs no count and no shuffle.
SMALL_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    Where none is set, a session in one process gets a local one; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return f"{found.rstrip('/')}/tessera"


def tuned(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a Python worker holds a few MB of texts at a time however long they are.

    Spark's driver starts a thread for each exchange until it has 1024, and each keeps its stack for a minute after its
    moment of work. A few do; this has an effect only before the session's first exchange.
    """
    for pool in ("shuffleExchange", "broadcastExchange", "resultQueryStage"):
        spark._jsparkSession.sessionState().conf().setConfString(f"spark.sql.{pool}.maxThreadThreshold", str(POOL_THREADS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4194304")
    return spark


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: While set, the paths of staged tables are noted in it.
_noted: list[list[str]] = []


@contextlib.contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Notes the staged tables that the block makes, so that a caller who knows when they are read can delete them."""
    _noted.append(paths)
    try:
        yield
    finally:
        _noted.pop()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Deletes staged tables by path."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _collect_garbage(spark: SparkSession) -> None:
    gc.collect()
    spark._jvm.System.gc()


def _much_garbage(spark: SparkSession) -> bool:
    """Whether half of the driver's heap is taken; many small jobs would let it grow to its limit."""
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    return 2 * (heap.totalMemory() - heap.freeMemory()) > heap.maxMemory()


def stage(df: DataFrame, slim: str = "", codec: str = "") -> DataFrame:
    """Writes a table to the shared folder and reads it again: cuts lineage, survives lost executors, keeps column pruning.

    Shuffle files that nothing refers to any more are dropped before and after a table that is not slim, rather than
    whenever the driver happens to collect its garbage, and whenever half of its heap is taken. ``codec`` is Parquet's compression for large texts. Slim tables are written as a sixteenth of the shuffle width in files: ``merge`` lets a writer take several partitions,
    for tables that are cheap to compute; ``deal`` shuffles the rows first, for those that are not.
    """
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    if _noted:
        _noted[-1].append(path)
    files = max(2, partitions(df.sparkSession) // 16)
    out = df.coalesce(files) if slim == "merge" else df.repartition(files) if slim == "deal" else df
    if not slim or _much_garbage(df.sparkSession):
        _collect_garbage(df.sparkSession)
    out.write.parquet(path, compression=codec or None)
    if not slim:
        _collect_garbage(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f"{shared_dir(spark).split(':', 1)[-1].lstrip('/')}/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, most: int | None = None) -> bool:
    """Whether the optimizer's estimate, for a staged table the size of its files, is at most SMALL_BYTES. No job runs."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= (SMALL_BYTES if most is None else most)


def hot_keys(counted: DataFrame, key: str, total: int, count: str = "count") -> list:
    """The keys of a table of counts that hold more than 1/HOT_KEYS of the rows (at most HOT_KEYS of them)."""
    floor = max(LEAST_HOT, total // HOT_KEYS)
    return [r[0] for r in counted.where(F.col(key).isNotNull() & (F.col(count) > floor)).select(key).collect()]


def lookup(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: list | None = None) -> DataFrame:
    """Joins ``left``, in which a key may hold most rows, with ``right``, which has slim rows and each key once.

    A small right side is broadcast. Else rows of hot keys meet the few right rows of these keys by broadcast (at most
    HOT_KEYS rows), and all others shuffle.
    """
    if small(right):
        return left.join(F.broadcast(right), key, how)
    if hot is None:
        hot = hot_keys(left.groupBy(key).count(), key, left.count())
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    many = left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how)
    return many.unionByName(left.where(~is_hot).join(right.where(~is_hot), key, how))


def ranked(df: DataFrame, groups: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Numbers the rows of each group from 0 in the given order, without one task holding a group.

    Rows are dealt by range of (groups, order) and staged with their place; counts by partition give each partition's
    offset. Null group values form a group. Keep the rows slim: they are shuffled and written once.
    """
    keys = [*map(F.col, groups), *order]
    placed = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = stage(placed.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("_part", *groups).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    runs = runs.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in groups], "_first", "_before")
    on = placed["_part"] == runs["_p"]
    for g in groups:
        on = on & placed[g].eqNullSafe(runs[f"_g_{g}"])
    out = placed.join(runs, on, "left")
    return out.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).select(*df.columns, name)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``(a, b)``: one row ``(node, root)`` per linked node, root the smallest node reachable.

    Rounds of hooking to the smallest neighbour, pointer jumping and contraction; every round at least halves what is
    left of a component's local minima. Links of a node to itself and nulls are ignored; no links give no rows.
    """
    links = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct()
    links, labels = stage(links, "merge"), None
    while not links.isEmpty():
        both = links.select(F.col("hi").alias("node"), F.col("lo").alias("to")).union(links.select("lo", "hi"))
        tree = stage(both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("root")), "merge")
        while True:
            above = tree.select(F.col("node").alias("root"), F.col("root").alias("top")).where("root <> top")
            moved = stage(above, "merge")
            if lookup(tree, moved, "root").isEmpty():
                break
            jumped = lookup(tree, moved, "root", "left")
            old, tree = tree, stage(jumped.select("node", F.coalesce("top", "root").alias("root")), "merge")
            drop(old, moved)
        if labels is None:
            labels = tree
        else:
            step = tree.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = stage(lookup(labels, step, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "merge")
        low = lookup(links, tree.select(F.col("node").alias("lo"), F.col("root").alias("lo_root")), "lo")
        low = stage(low.select("hi", "lo_root"), "merge")
        high = lookup(low, tree.select(F.col("node").alias("hi"), F.col("root").alias("hi_root")), "hi")
        rest = high.select(F.least("lo_root", "hi_root").alias("lo"), F.greatest("lo_root", "hi_root").alias("hi"))
        old, links = links, stage(rest.where("lo < hi").distinct(), "merge")
        drop(old, low)
    return labels if labels is not None else links.select(F.col("lo").alias("node"), F.col("hi").alias("root"))


def files(uri: str) -> tuple:
    """(file system, path) of a folder in the shared storage, for real files that Python writes and reads."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def range_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most n - 1 ascending bounds that cut a long key into ranges of like size, from a quantile sketch over it alone.

    A key that fills several ranges is as many bounds.
    """
    shares = [k / n for k in range(1, n)]
    if not shares:
        return []
    sketch = F.percentile_approx(key, F.array(*map(F.lit, shares)), F.lit(max(10_000, 20 * n)))
    return sorted(df.select(sketch).first()[0] or [])


def range_number(bounds: list[int], key: str) -> Column:
    """The number of a key's range, from 0; null keys are in the first."""
    edges = np.array(sorted(set(bounds)), np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        known = keys.notna().to_numpy()
        out = np.zeros(len(keys), np.int32)
        out[known] = np.searchsorted(edges, keys[known].to_numpy(np.int64), "left")
        return pd.Series(out)

    return place(F.col(key))


def split_range_number(bounds: list[int], key: str, tie: str) -> Column:
    """The number of a row's range, from 0, by (key, tie); ``tie`` is a long hash. Keys that are not null only.

    A key that is one bound or several goes to the ranges around them by equal shares of the tie's values, in its order.
    """
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series, ties: pd.Series) -> pd.Series:
        keys = keys.to_numpy(np.int64)
        first, after = np.searchsorted(edges, keys, "left"), np.searchsorted(edges, keys, "right")
        share = (ties.to_numpy(np.int64).astype(np.float64) + 2.0**63) / 2.0**64
        return pd.Series(np.minimum(first + (share * (after - first + 1)).astype(np.int64), after).astype(np.int32))

    return place(F.col(key), F.col(tie))
