import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import common
from tests.llm import helpers


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_of_a_small_table_needs_no_shuffle_and_no_job(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).cast("long").alias("key"), "id")
    right = common.stage(spark.range(5, 40).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice")))
    spark.sparkContext.setJobGroup(f"lookup-{how}", "")
    met = common.lookup(left, right, "key", how)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"lookup-{how}")
    assert "hashpartitioning" not in met._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(tuple, met.collect()), key=lambda r: r[1])
    keys = [(7 if i % 3 else i % 50, i) for i in range(3000)]
    assert rows == [(k, i, 2 * k if 5 <= k < 40 else None) for k, i in keys if how == "left" or 5 <= k < 40]


@pytest.mark.parametrize("most", [common.SMALL_BYTES, 0])
def test_components_of_small_and_large_tables(spark, monkeypatch, most):
    monkeypatch.setattr(common, "SMALL_BYTES", most)
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(180)] + [(500, k) for k in range(501, 900)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == helpers.components(linked, [x for x in links if x[0] != x[1]])


def test_a_driver_whose_heap_fills_collects_before_slim_tables_too(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_collect_garbage", calls.append)
    common.stage(spark.range(3), "merge")
    assert not calls or common._much_garbage(spark)
    monkeypatch.setattr(common, "_much_garbage", lambda spark: True)
    before = len(calls)
    common.stage(spark.range(3), "merge")
    assert len(calls) == before + 1


def test_exchanges_of_a_tuned_session_share_few_threads(spark):
    conf = common.tuned(spark)._jsparkSession.sessionState().conf()
    pools = [int(conf.getConfString(f"spark.sql.{p}.maxThreadThreshold")) for p in ("shuffleExchange", "broadcastExchange", "resultQueryStage")]
    assert max(pools) <= 32
