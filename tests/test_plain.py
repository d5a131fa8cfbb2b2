"""Queries without SQL against plain versions over the same rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators.ranges import at_least, placed, tile
from tessera.operators.regress import newey_west, ridge, ridge_from_sums
from tessera.plans import funds, serving
from tessera.plans.panel import returns


def test_ridge_scores_equal_a_fit_on_all_earlier_rows(spark, sf):
    names = ["r3", "r6", "vol12"]
    rows = funds.features(spark, sf).toPandas()
    month = rows.groupby("month")
    for c in names:
        rows[c] = month[c].rank() / (month[c].transform("size") + 1) - 0.5
    rows["y"] = rows.nxt - month.nxt.transform("mean")
    rows["month"] = pd.to_datetime(rows.month)
    want = {}
    for year in sorted(rows.month.dt.year.unique())[2:]:
        past = rows[(rows.month < pd.Timestamp(year - 1, 12, 1)) & rows.y.notna()]
        if len(past) >= 20:
            beta, alpha = ridge(past[names].to_numpy(float), past[["y"]].to_numpy(float), 10.0)
            for r in rows[rows.month.dt.year == year].itertuples():
                want[r.idx, r.month.date()] = sum(getattr(r, c) * b for c, b in zip(names, beta[:, 0])) + alpha[0]
    got = {(r.idx, r.month): r.score for r in funds.fund_ridge_scores(spark, sf).collect()}
    assert len(want) > 100 and set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=2e-8) for k in want)


def test_ridge_from_sums_is_the_ridge_of_the_rows():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(80, 4)) * [1, 5, 0, 2] + [0, 3, 7, -1], rng.normal(size=(80, 1))
    beta, alpha = ridge(x, y, 3.0)
    got, start = ridge_from_sums(80, x.sum(axis=0), x.T @ x, y.sum(), x.T @ y[:, 0], 3.0)
    assert got == pytest.approx(beta[:, 0]) and start == pytest.approx(alpha[0])


def test_the_gate_of_each_index(spark, sf):
    rows = funds.trend_states(spark, sf).where("up is not null and ret is not null").toPandas()
    rows["x"] = rows.ret - rows.rf
    for r in funds.fund_asset_gate(spark, sf).collect():
        own = rows[rows.idx == r.idx].sort_values("mn")
        up, x = own.up.to_numpy(bool), own.x.to_numpy(float)
        assert r.months == len(own)
        if not 3 <= up.sum() <= len(up) - 3:
            assert r.slope is None or np.isnan(r.slope)
            continue
        slope = x[up].mean() - x[~up].mean()
        parts = [(v - x[up].mean()) / up.mean() if u else -(v - x[~up].mean()) / (~up).mean() for u, v in zip(up, x)]
        assert r.slope == pytest.approx(slope, abs=1e-7) and r.t == pytest.approx(slope / newey_west(np.array(parts), 5)[1], abs=1e-4)


def test_the_tracking_portfolio(spark, sf):
    rows = returns(spark, sf).where("ret is not null").select("date", "key", "ret").toPandas()
    wide = rows[rows.key <= 8].pivot(index="date", columns="key", values="ret").reindex(columns=range(1, 9))
    target = rows.groupby("date").ret.mean()
    got = {r.date: r for r in serving.mimic_portfolio(spark, sf).collect()}
    assert all(got[d].target == pytest.approx(target[d], abs=1e-6) for d in got)
    x, y, dates, at = wide.to_numpy(float), target[wide.index].to_numpy(float), list(wide.index), 24
    a, b = x[:24], y[:24]
    ok = np.isfinite(a).all(axis=1)
    if ok.sum() >= 12 and np.isfinite(x[at]).all():
        a, b = a[ok], b[ok]
        mid = a - a.mean(axis=0)
        w = np.linalg.solve(mid.T @ mid + 1e-4 * (a**2).sum() / 8 * np.eye(8), mid.T @ (b - b.mean()))
        assert got[dates[at]].mimic == pytest.approx(x[at] @ w, abs=1e-6)


def test_places_and_counts_by_ranges(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.exponential(size=2000), 2)
    values[:700] = 0.5
    rows = spark.createDataFrame([(i, float(v), "ab"[i % 2]) for i, v in enumerate(values)], "i long, v double, g string").repartition(5)
    got = {r.i: (r.place, r.n) for r in placed(rows, "v", "i").collect()}
    order = sorted(range(2000), key=lambda i: (values[i], i))
    assert got == {i: (k + 1, 2000) for k, i in enumerate(order)}
    for r in at_least(rows, ["g"], "v").collect():
        own = values["ab".index(r.g) :: 2]
        assert (r.at_least, r["all"]) == ((own >= r.v).sum(), 1000)
    tiles = spark.range(1, 12).select(tile(F.col("id"), F.lit(11), 4).alias("t")).collect()
    assert [r.t for r in tiles] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4]


def test_no_window_holds_all_rows(spark, sf):
    """Windows without a key stand over a row a session, a range or a period, never over the rows themselves."""
    for query in (funds.fund_ridge_scores,):
        plan = query(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
