import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import frame
from pulsegrid.functions.numeric import normal_cdf
from pulsegrid.operators import forecast, unit_root
from pulsegrid.operators.runs import each_run, lag_products, placed, series_scale, stream, summed
from pulsegrid.plans.blocked import forced_blocks
from datetime import datetime, timedelta

T0 = datetime(2023, 1, 1)


def _rows(series):
    return [(sid, T0 + timedelta(hours=i), i, float(v)) for sid, values in series.items() for i, v in enumerate(values)]


def _ar(n, phi, seed):
    e = np.random.default_rng(seed).standard_normal(n)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = phi * x[t - 1] + e[t]
    return x


def _plain_products(x, lags):
    return [sum(x[t] * x[t - k] for t in range(k, len(x))) for k in range(lags + 1)]


def test_published_p_values(spark):
    # 1, 5 and 10 percent points of the asymptotic distribution with constant
    pairs = [(-3.43035, 0.01), (-2.86154, 0.05), (-2.56677, 0.10), (-20.0, 0.0), (3.0, 1.0)]
    df = spark.createDataFrame([(t,) for t, _ in pairs], "t double")
    got = [r.p for r in df.select(unit_root.p_value(F.col("t")).alias("p")).collect()]
    assert got == pytest.approx([p for _, p in pairs], abs=2e-3)


def test_normal_distribution_function(spark):
    xs = np.linspace(-6, 6, 241).tolist()
    got = [r.p for r in spark.createDataFrame([(x,) for x in xs], "x double").select(normal_cdf(F.col("x")).alias("p")).collect()]
    assert max(abs(p - 0.5 * math.erfc(-x / math.sqrt(2))) for x, p in zip(xs, got)) < 7.5e-8


def test_normal_equations_from_lag_products_equal_the_design_matrix():
    r = np.random.default_rng(5)
    for n, L in ((40, 6), (25, 0), (60, 11)):
        y = np.cumsum(r.standard_normal(n))
        dy = np.diff(y)
        sums = np.concatenate([_plain_products(dy, L), [y.sum(), y @ y], y[: L + 2], y[n - L - 2 :]])
        for p in range(L + 1):
            for s in {p + 1, L + 1}:
                t = np.arange(s, n)
                X = np.column_stack([np.ones(len(t)), y[t - 1], *[dy[t - 1 - j] for j in range(1, p + 1)]])
                gram, xty, yty, rows = unit_root.regression(sums, n, L, p, s)
                assert rows == len(t)
                assert np.allclose(gram, X.T @ X) and np.allclose(xty, X.T @ dy[t - 1]) and np.isclose(yty, dy[t - 1] @ dy[t - 1])


def test_levinson_equals_the_toeplitz_system():
    x = _ar(500, 0.7, 1)
    m = 8
    sums = np.concatenate([_plain_products(x, m), [x.sum()], x[:m], x[-m:]])
    gamma, mean = forecast.autocovariances(sums, len(x), m)
    c = x - x.mean()
    assert mean == pytest.approx(x.mean())
    assert np.allclose(gamma, np.array(_plain_products(c, m)) / len(x))
    phi, var = forecast.levinson(gamma)
    toeplitz = np.array([[gamma[abs(i - j)] for j in range(m)] for i in range(m)])
    assert np.allclose(phi, np.linalg.solve(toeplitz, gamma[1:])) and var == pytest.approx(gamma[0] - phi @ gamma[1:])
    assert forecast.levinson(np.zeros(4))[0].tolist() == [0, 0, 0]


def test_runs_of_any_cut_give_the_same_sums(spark):
    series = {"a": _ar(230, 0.5, 2), "b": _ar(3, 0.5, 3), "c": _ar(61, 0.9, 4)}
    df = frame(spark, _rows(series)).repartition(7)
    heads = series_scale(df).select("series_id", "_n", F.lit(9).alias("_reach"), F.array(F.col("_n").cast("double")).alias("_head"))

    def sums(head, first, before, x):
        own = first + before
        return np.concatenate([lag_products(x, before, 8), placed(x, first, own, 0, 5), placed(x, first, own, int(head[0]) - 3, 3)])

    want = {k: np.concatenate([_plain_products(x, 8), np.pad(x[:5], (0, 5 - len(x[:5]))), x[-3:]]) for k, x in series.items()}
    for plan, size in (("plain", 0), ("blocked", 50), ("blocked", 7), ("blocked", 1000)):
        with forced_blocks(size or 50):
            got = {r.series_id: np.array(r.v) for r in summed(stream(df, heads, plan), sums, plan).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert np.allclose(got[k], want[k]), (plan, size, k)


def test_a_long_series_does_not_widen_the_others(spark):
    n = spark.range(200_000).select(F.lit("long").alias("series_id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"), F.sin(F.col("id") * 1.7).alias("value"))
    short = spark.range(30_000).select((F.col("id") % 1000).cast("string").alias("series_id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"), F.cos(F.col("id") * 2.3).alias("value"))
    df = n.unionByName(short)
    known = series_scale(df).withColumn("d0", F.lit(0))
    widths = {}
    for name, x in (("with", df), ("alone", short)):
        scale = known if name == "with" else known.where("series_id <> 'long'")
        ar = forecast._autoregressions(x, scale, 0, 0, 1, 2, None, "plain").select("series_id", F.size("phi").alias("k"))
        widths[name] = {r.series_id: r.k for r in ar.collect()}
    assert widths["with"].pop("long") == math.ceil(2 * 200_000 ** (1 / 3))
    assert widths["with"] == widths["alone"] and set(widths["alone"].values()) == {7}


def test_blocked_equals_plain_with_lags(spark):
    series = {"walk": np.cumsum(_ar(400, 0.3, 8)), "ar": _ar(300, 0.6, 9), "tiny": np.arange(4.0), "flat": np.ones(50)}
    df = frame(spark, _rows(series))
    with forced_blocks(64):
        got = {r.series_id: r for r in forecast.adf_test(df, plan="blocked").collect()}
        orders = {r.series_id: r.d for r in forecast.auto_difference(df, plan="blocked").collect()}
        fits = {r.series_id: r.params for r in forecast.arima_fit(df, (1, 0, 1), plan="blocked").collect()}
    want = {r.series_id: r for r in forecast.adf_test(df, plan="plain").collect()}
    assert orders == {r.series_id: r.d for r in forecast.auto_difference(df, plan="plain").collect()}
    for k, w in want.items():
        assert got[k].lags == w.lags and got[k].stationary == w.stationary and got[k].n == w.n
        assert got[k].t_stat == (pytest.approx(w.t_stat, rel=1e-8) if w.t_stat is not None else None)
    assert want["flat"].t_stat is None and want["walk"].stationary is False and want["ar"].stationary is True
    for r in forecast.arima_fit(df, (1, 0, 1), plan="plain").collect():
        assert fits[r.series_id] == pytest.approx(r.params, rel=1e-6)
