"""Every query against its SQL on the smallest tables, and the shape of the driver's contract."""

import datetime
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import models

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
PLAIN = [n for n in entry.queries() if not re.match(r"op\d+_", n) and n != "pipeline"]


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-5)
    return a == b


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, f"{x:.3e}" if isinstance(x, float) else str(x)) for x in r))


@pytest.mark.parametrize("name", PLAIN)
def test_query_equals_its_sql(spark, sf, oracle, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    if name not in entry.oracle_sql():
        assert got and all(math.isfinite(v) for r in got for v in r if isinstance(v, float))
        return
    found = oracle.sql(entry.oracle_sql()[name])
    assert sorted(found.columns) == columns
    want = [tuple(plain(dict(zip(found.columns, r))[c]) for c in columns) for r in found.fetchall()]
    assert len(got) == len(want)
    assert all(same(x, y) for a, b in zip(in_order(got), in_order(want)) for x, y in zip(a, b))


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_no_query_pairs_everything(spark, sf):
    for name in ("avg_rank_ic", "span_join_adjust", "holdings_overlap", "related_by_corr", "asof_backward"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = entry.queries()["scan_partition_range"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "l_comment" not in plan and "l_extendedprice" not in plan


def test_messages_and_scores_at_ties_equal_the_sql(spark, tmp_path, monkeypatch):
    """Shares like 0.925 and correlations like 0.565 are ties that engines round by different rules."""
    shares, corrs, moves = [0.925, 0.975, 0.945055, 0.978495, 0.95], [0.565, -0.575, 0.50013, 0.56155, 0.7], [0.5005, -0.5055, 0.50013, 1.2345, -0.61]
    rows = [(k, p, 0.28305 + k, -0.7325 - k / 1000, p, c, r) for k, (p, c, r) in enumerate(zip(shares, corrs, moves))]
    risk = spark.createDataFrame(rows, "key long, vol_pctile double, vol double, drawdown double, dd_pctile double, market_corr double, ret_3 double")
    risk.write.parquet(f"{tmp_path}/risk")
    monkeypatch.setattr(models, "factor_risk", lambda spark, sf_dir: risk)
    got = models.exceptions_board(spark, "").collect()
    sql = entry.oracle_sql()["exceptions_board"].replace(entry.oracle_sql()["factor_risk"], f"SELECT * FROM '{tmp_path}/risk/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(duckdb.connect().sql(sql).fetchall())


def test_pairs_of_funds_are_not_shuffled(spark, sf):
    plan = entry.queries()["holdings_overlap"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("MapInArrow")[0] and "MapInArrow" in plan
