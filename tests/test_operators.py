import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions.scalar import as_printed, normal_p, par_bond_return, safe_div, two_sided_z
from tessera.operators import allocate, risk
from tessera.operators.learn import boosted_walk_forward
from tessera.operators import joins
from tessera.operators.joins import asof_join, overlaps, span_join, trailing_sum
from tessera.operators.regress import cross_section, eigenportfolios, newey_west, ridge, rolling_ridge, standardized
from tessera.operators.reshape import chain_roots, unpivot_known
from tessera.operators.robust import clipped, weighted_median
from tessera.operators.simulate import Book, backtest, bootstrap_paths, trade_cost
from tessera.operators.windows import average_rank, bucket


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame([("a", day(n), n) for n in (0, 2, 4, 6, 30)] + [("b", day(1), 9), (None, day(1), 10)], "k string, t date, v int")
    right = spark.createDataFrame([("a", day(2), "x", None), ("a", day(5), "y", 1), ("c", day(0), "z", 2)], "k string, u date, w string, v int")
    return left, right


@pytest.mark.parametrize(
    "options,want",
    [
        ({}, [None, "x", "x", "y", "y"]),
        ({"strict": True}, [None, None, "x", "y", "y"]),
        ({"direction": "forward"}, ["x", "x", "y", None, None]),
        ({"direction": "forward", "strict": True}, ["x", "y", "y", None, None]),
        ({"tolerance": 3}, [None, "x", "x", "y", None]),
    ],
)
def test_asof(sides, options, want):
    rows = asof_join(*sides, "t", "u", ["k"], **options)
    got = {(r.k, r.t): r for r in rows.collect()}
    assert [got["a", day(n)].w for n in (0, 2, 4, 6, 30)] == want
    assert got["b", day(1)].w is None and len(got) == 7 and "v_right" in rows.columns
    inner = asof_join(*sides, "t", "u", ["k"], how="inner", **options)
    assert inner.count() == sum(w is not None for w in want)


def test_asof_refuses_other_directions(sides):
    with pytest.raises(ValueError):
        asof_join(*sides, "t", "u", ["k"], direction="nearest")


def test_spans_and_trailing_sums(spark):
    left = spark.createDataFrame([(1, day(n)) for n in range(8)], "k int, t date")
    events = spark.createDataFrame([(1, day(2), 5.0), (1, day(5), 7.0)], "k int, at date, f double")
    got = {r.t: r.f for r in span_join(left, events, ["k"], "t", "at").collect()}
    assert [got[day(n)] for n in range(8)] == [None, None, 5.0, 5.0, 5.0, 7.0, 7.0, 7.0]
    sums = {r.t: r.s for r in trailing_sum(left, events, ["k"], "t", "at", "f", 4, "s").collect()}
    assert [sums[day(n)] for n in range(8)] == [0, 0, 5, 5, 5, 12, 7, 7]


def test_average_ranks_share_ties(spark):
    df = spark.createDataFrame([(1, x) for x in (3.0, 1.0, 3.0, 2.0)] + [(2, 5.0)], "g int, x double")
    rows = df.select("g", "x", average_rank(["g"], "x").alias("r")).orderBy("g", "x").collect()
    assert [r.r for r in rows] == [1.0, 2.0, 3.5, 3.5, 1.0]
    assert df.select(bucket(F.lit(3.5), F.lit(4), 5).alias("b")).first().b == 5


def test_scalars(spark):
    one = spark.range(1)
    q = [0.0027, 0.05, 0.3173, 1.0]
    z = [one.select(two_sided_z(F.lit(x)).alias("z")).first().z for x in q]
    assert z == pytest.approx([2.99998, 1.95996, 1.00002, 0.0], abs=1e-4)
    p = [one.select(normal_p(F.lit(t)).alias("p")).first().p for t in (0.0, 1.96, -3.0)]
    assert p == pytest.approx([1.0, 0.05, 0.0027], abs=1e-4)
    for y in (0.03, 0.05):
        same = one.select(par_bond_return(F.lit(y), F.lit(y), 10).alias("r")).first().r
        assert same == pytest.approx(y / 12)
    coupons = sum(0.02 / (1 + 0.03) ** k for k in range(1, 21)) + 1 / 1.03**20  # a fall in price when yields rise
    rise = one.select(par_bond_return(F.lit(0.04), F.lit(0.06), 10 + 1 / 12).alias("r")).first().r
    assert rise == pytest.approx(coupons - 1 + 0.04 / 12, abs=1e-9)
    assert one.select(safe_div(F.lit(1.0), F.lit(0.0)).alias("x")).first().x is None


def test_chains_and_cycles(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 12)] + [(30, 31), (50, 51), (51, 50)], "old long, new long")
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = {r.member: (r.root, r.steps) for r in chain_roots(links).collect()}
    assert got == {i: (1, i - 1) for i in range(2, 13)} | {31: (30, 1)}


def test_unpivot_drops_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "k int, a double, b double")
    assert [tuple(r) for r in unpivot_known(df, ["k"], ["a", "b"]).collect()] == [(1, "a", 2.0)]


def panel(seed=0, days=30, names=120):
    rng = np.random.default_rng(seed)
    rows = []
    for t in range(days):
        style = rng.normal(0, 0.02)
        for k in range(names):
            x = rng.normal()
            rows.append((t, k, float(x), float(1 + k % 7), f"g{k % 3}", float(0.01 * (k % 3) + style * x + rng.normal(0, 0.001))))
    return pd.DataFrame(rows, columns=["day", "key", "x", "w", "g", "ret"])


def test_cross_section_recovers_planted_returns(spark):
    data = panel()
    got = cross_section(spark.createDataFrame(data), "day", "ret", "w", ["x"], group="g", least=100).toPandas()
    one = data[data.day == 3]
    design = np.column_stack([*(one.g == f"g{i}" for i in range(3)), one.x]).astype(float)
    root = np.sqrt(one.w.to_numpy())[:, None]
    beta = np.linalg.lstsq(design * root, one.ret.to_numpy() * root[:, 0], rcond=None)[0]
    found = got[got.day == 3].set_index("factor").ret
    caps = one.groupby("g").w.sum().to_numpy()
    market = caps @ beta[:3] / caps.sum()
    assert found["x"] == pytest.approx(beta[3]) and found["market"] == pytest.approx(market) and found["g1"] == pytest.approx(beta[1] - market)
    assert sum(caps * found[["g0", "g1", "g2"]].to_numpy()) == pytest.approx(0, abs=1e-9)
    assert cross_section(spark.createDataFrame(data), "day", "ret", "w", ["x"], least=500).count() == 0


def test_standardizing(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(5, 2, 200)
    x[:3] = [500, -400, np.nan]
    w = rng.random(200) + 0.1
    df = spark.createDataFrame(pd.DataFrame({"d": 1, "i": range(200), "x": x, "w": w})).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    got = standardized(df, ["d"], "x", "w", "z").orderBy("i").toPandas().z.to_numpy()
    ok = np.isfinite(x)
    med = np.median(x[ok])
    mad = 1.4826 * np.median(np.abs(x[ok] - med))
    v = np.clip(x, med - 5 * mad, med + 5 * mad)
    z = np.clip((v - np.average(v[ok], weights=w[ok])) / v[ok].std(), -3, 3)
    assert got[2] == 0 and got[ok] == pytest.approx(z[ok])
    few = standardized(df.where("i in (5, 6)"), ["d"], "x", "w", "z").toPandas().z
    assert (few == 0).all()


def test_newey_west():
    x = np.random.default_rng(2).normal(size=400)
    assert newey_west(x, 0)[1] == pytest.approx(x.std() / 20)
    overlapping = np.convolve(x, np.ones(5), "valid")
    assert newey_west(overlapping, 10)[1] > 1.5 * newey_west(overlapping, 0)[1]
    d = overlapping - overlapping.mean()
    s = d @ d / len(d) + sum(2 * (1 - k / 4) * (d[k:] @ d[:-k]) / len(d) for k in (1, 2, 3))
    assert newey_west(overlapping, 3)[1] == pytest.approx(math.sqrt(s / len(d)))
    assert math.isnan(newey_west(np.array([1.0]), 3)[1])


def test_ridge():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=300), rng.normal(size=300), np.ones(300)])
    y = (2 * x[:, [0]] - x[:, [1]]) + 0.5
    beta, alpha = ridge(x, y, 1e-9)
    assert beta[:, 0] == pytest.approx([2, -1, 0], abs=1e-6) and alpha[0] == pytest.approx(0.5)
    assert abs(ridge(x, y, 300.0)[0][0, 0]) < 1.2


def test_walk_forward_fits_read_the_past_only(spark):
    data = panel(days=60, names=25)
    market = data.groupby("day").ret.mean().rename("m")
    frame = data.merge(market, on="day")
    fits = rolling_ridge(spark.createDataFrame(frame), "key", "day", "ret", ["m"], window=30, step=10, least=20, penalty=1.0)
    spoiled = frame.copy()
    spoiled.loc[spoiled.day >= 50, "ret"] = 9.0
    other = rolling_ridge(spark.createDataFrame(spoiled), "key", "day", "ret", ["m"], window=30, step=10, least=20, penalty=1.0)
    a, b = (f.where("fit_date <= 50").orderBy("key", "fit_date", "factor").toPandas() for f in (fits, other))
    assert len(a) == 25 * 3 * 2 and a.loading.to_numpy() == pytest.approx(b.loading.to_numpy())
    got = eigenportfolios(spark.createDataFrame(data.assign(size=data.w)), "key", "day", "ret", "size", window=30, step=10, k=2, n_names=20).toPandas()
    assert sorted(got.day.unique()) == list(range(30, 60)) and set(got.n) == {20} and got.share.between(0, 1).all()
    one = data[(data.day < 30)].pivot(index="day", columns="key", values="ret")
    last = data[data.day == 29].sort_values(["w", "key"], ascending=[False, True]).key[:20]
    z = (one[last] - one[last].mean()) / one[last].std()
    v = np.linalg.svd(z.to_numpy(), full_matrices=False)[2][0] / one[last].std().to_numpy()
    v = v / np.abs(v).sum() * np.sign(v.sum())
    now = data[data.day == 30].set_index("key").ret[last].to_numpy()
    assert got[(got.day == 30) & (got.component == 0)].ret.iloc[0] == pytest.approx(now @ v)


@pytest.mark.parametrize("rows,names", [(400, 30), (60, 90)])
def test_covariances(rows, names):
    rng = np.random.default_rng(5)
    truth = rng.normal(size=(names, 2))
    x = rng.normal(size=(rows, 2)) @ truth.T * 0.5 + rng.normal(size=(rows, names))
    real = truth @ truth.T * 0.25 + np.eye(names)
    error = lambda s: np.linalg.norm(s - real)
    for estimate in (risk.statistical, risk.cleaned, risk.shrunk):
        s = estimate(x)
        assert s == pytest.approx(s.T) and np.linalg.eigvalsh(s).min() > 0 and error(s) < 1.05 * error(risk.sample(x))
    assert risk.weighted(x, 1e12) == pytest.approx(risk.sample(x))
    assert np.trace(risk.shrunk(x)) == pytest.approx(np.trace(risk.sample(x)))
    w = risk.least_variance(risk.shrunk(x))
    assert w.sum() == pytest.approx(1) and risk.variance_split(w, real).sum() == pytest.approx(1)
    s, loadings = risk.from_factors(x, rng.normal(size=(rows, 2)))
    assert s.shape == (names, names) and loadings.shape == (names, 2)
    assert risk.from_exposures(truth, rng.normal(size=(rows, 2)), np.ones(names)).shape == (names, names)


def test_weights():
    w = risk.simplex(np.array([0.9, 0.5, -0.2]))
    assert w == pytest.approx([0.7, 0.3, 0.0])
    assert risk.inverse_volatility(np.diag([1.0, 4.0])) == pytest.approx([2 / 3, 1 / 3])


def test_book_locks():
    book = Book(days=30, per_lot=True)
    book.buy("a", 5, 0)
    book.buy("a", 3, 20)
    assert (book.free("a", 29), book.free("a", 30), book.free("a", 50)) == (0, 5, 8)
    assert book.sell("a", 7, 31) == 5 and book.units("a") == 3
    strict = Book(days=30, per_lot=False)
    strict.buy("a", 5, 0)
    strict.buy("a", 1, 20)
    assert strict.free("a", 40) == 0 and strict.free("a", 50) == 6 and strict.sell("a", 6, 50) == 6


def test_backtest():
    returns = np.array([[0.1, 0.0], [0.0, 0.1], [-0.5, 0.0]])
    out = backtest(returns, {0: np.array([1.0, 0.0])}, 100.0, half_spread=0.0)
    assert out["wealth"] == pytest.approx([100, 110, 110, 55]) and out["drawdown"] == pytest.approx(-0.5)
    cost = backtest(returns, {0: np.array([0.5, 0.5]), 2: np.array([0.0, 1.0])}, 100.0, half_spread=0.01)
    assert cost["cost"] > 0 and cost["wealth"][-1] > 100
    assert trade_cost(np.array([1e6]), np.array([0.001]), np.array([0.02]), np.array([1e8])) == pytest.approx([1e6 * (0.001 + 0.6 * 0.02 * 0.1)])


def test_bootstrap_does_not_depend_on_partitions(spark):
    returns = np.random.default_rng(6).normal(0.01, 0.03, (120, 2))
    a = bootstrap_paths(spark, returns, np.array([0.5, 0.5]), 50, 24, 6.0).orderBy("path").toPandas()
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
    b = bootstrap_paths(spark, returns, np.array([0.5, 0.5]), 50, 24, 6.0).orderBy("path").toPandas()
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert a.equals(b) and a.final.mean() == pytest.approx(1.01**24, rel=0.1) and (a.drawdown <= 0).all()


def test_allocations():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(6, 6))
    cov, mean = a @ a.T + np.eye(6), rng.normal(0.1, 0.1, 6)
    for w in (allocate.minimum_variance(cov), allocate.equal_risk(cov), allocate.most_diversified(cov), allocate.mean_variance(mean, cov), allocate.resampled(mean, cov, 60, 5)):
        assert w.sum() == pytest.approx(1) and w.min() >= -1e-12
    least = allocate.minimum_variance(cov)
    for _ in range(200):
        other = rng.dirichlet(np.ones(6))
        assert least @ cov @ least <= other @ cov @ other + 1e-9
    assert risk.variance_split(allocate.equal_risk(cov), cov) == pytest.approx(np.full(6, 1 / 6), abs=1e-6)
    bench = np.full(6, 1 / 6)
    near = allocate.within_tracking_error(mean, cov, bench, 0.05)
    assert np.sqrt((near - bench) @ cov @ (near - bench)) <= 0.0501 and near @ mean > bench @ mean
    line = allocate.frontier(mean, cov)
    assert all(x[0] <= y[0] + 1e-6 and x[1] <= y[1] + 1e-6 for x, y in zip(line, line[1:]))


def test_holding_rules():
    returns = np.tile([0.1, 0.0], (24, 1))
    never, yearly, drift = (allocate.held(returns, np.array([0.5, 0.5]), rule) for rule in ("never", "yearly", "drift"))
    assert never[-1] == pytest.approx(0.5 * 1.1**24 + 0.5) and never[-1] > yearly[-1] > drift[-1]
    assert yearly[12] == pytest.approx(never[12])
    with pytest.raises(ValueError):
        allocate.held(returns, np.array([1.0, 0.0]), "daily")


def test_weighted_medians_and_clipping(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 1.0), (1, 50.0, 1.5), (1, None, 9.0), (2, 4.0, 1.0), (2, 4.0, 1.0)], "g int, x double, w double")
    assert {r.g: r.m for r in weighted_median(df, ["g"], "x", "w", "m").collect()} == {1: 2.0, 2: 4.0}
    got = sorted((r.x, r.c) for r in clipped(df, ["g"], "x", "w", 2.0, "c").where("x is not null").collect())
    assert got == [(1.0, 1.0), (2.0, 2.0), (4.0, 4.0), (4.0, 4.0), (50.0, pytest.approx(2 + 2 * 1.4826 * 1.0))]


def test_boosted_walk_forward(spark):
    rng = np.random.default_rng(9)
    x = rng.random((400, 2))
    data = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": np.where(x[:, 0] > 0.5, 1.0, 0.0), "p": np.arange(400) // 100})
    data["ends"] = data.p
    got = boosted_walk_forward(spark.createDataFrame(data), ["a", "b"], "y", "p", "ends", [0, 1, 3], trees=3).toPandas()
    assert sorted(got.p.unique()) == [1, 3] and ((got.score > 0.5) == (got.y > 0.5)).mean() > 0.95


def test_printed_numbers_round_as_c_does(spark):
    values = [0.565, 0.575, -0.565, 0.125, 0.375, 1.005, 2.675, 92.5, 93.5, 50.05, -50.05, 0.05, -0.04, -0.25, -0.5, 0.0, 123456.785, 99.95]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for r in rows.select("x", *[F.format_string(f"%+.{d}f", as_printed(F.col("x"), d)).alias(f"d{d}") for d in (0, 1, 2)]).collect():
        assert [r.d0, r.d1, r.d2] == [f"{r.x:+.{d}f}" for d in (0, 1, 2)]


def test_overlaps_in_blocks_shuffle_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK_KEYS", 7)
    rng = np.random.default_rng(3)
    held = {(int(k), f"i{int(i)}"): float(w) if w > 0.1 else None for k, i, w in zip(rng.integers(0, 40, 300), rng.integers(0, 25, 300), rng.random(300))}
    rows = [(k, i, w) for (k, i), w in held.items()] + [(None, "i1", 0.5), (3, None, 0.5)]
    out = overlaps(spark.createDataFrame(rows, "k long, i string, w double"), "k", "i", "w")
    assert "HashAggregate(keys=[a" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for (a, i), x in held.items():
        for (b, j), y in held.items():
            if a < b and i == j:
                least = [v for v in (x, y) if v is not None]
                want.setdefault((a, b), []).extend([min(least)] if least else [])
    got = {(r.a, r.b): r.overlap for r in out.collect()}
    assert set(got) == set(want) and out.count() == len(want)
    assert all(got[p] == (pytest.approx(sum(v), abs=1e-6) if v else None) for p, v in want.items())
