"""Recovery tests for the estimators (the reference has none for its models)."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, frame
from pulsegrid.operators import anomaly, baselines, clean, columns, forecast, rolling
from pulsegrid.operators.rolling import FEATURES
from pulsegrid.sources import panels

T0 = datetime(2023, 1, 1)


def _series(spark, values, sid):
    return frame(spark, [(sid, T0 + timedelta(hours=i), i, float(v)) for i, v in enumerate(values)])


def _arma(n, phi, theta, seed):
    rng = np.random.default_rng(seed)
    e = rng.standard_normal(n + 100)
    x = np.zeros(n + 100)
    for t in range(1, n + 100):
        x[t] = phi * x[t - 1] + e[t] + theta * e[t - 1]
    return x[100:]


def test_adf_separates_random_walk_from_ar(spark):
    rng = np.random.default_rng(7)
    walk = np.cumsum(rng.standard_normal(1000))
    ar = _arma(1000, 0.5, 0.0, 8)
    df = _series(spark, walk, "walk").unionByName(_series(spark, ar, "ar"))
    got = {r["series_id"]: r for r in forecast.adf_test(df).collect()}
    assert got["ar"]["stationary"] is True
    assert got["walk"]["stationary"] is False
    d = {r["series_id"]: r["d"] for r in forecast.auto_difference(df).collect()}
    assert d == {"ar": 0, "walk": 1}


def test_a_constant_level_changes_nothing(spark):
    ar, walk = _arma(500, 0.5, 0.0, 21), np.cumsum(np.random.default_rng(22).standard_normal(500))
    df = None
    for level in (0.0, 1e5, 1e8, 1e9):
        for name, x in (("ar", ar), ("walk", walk)):
            part = _series(spark, x + level, f"{name}-{level:g}")
            df = part if df is None else df.unionByName(part)
    got = {r["series_id"]: r for r in forecast.adf_test(df).collect()}
    d = {r["series_id"]: r["d"] for r in forecast.auto_difference(df).collect()}
    fits = {r["series_id"]: r for r in forecast.arima_fit(df, (1, 0, 1), auto_stationary=False).collect()}
    for name, want in (("ar", 0), ("walk", 1)):
        zero = got[f"{name}-0"]
        for level in (1e5, 1e8, 1e9):
            k = f"{name}-{level:g}"
            assert got[k]["lags"] == zero["lags"] and got[k]["stationary"] == zero["stationary"]
            assert got[k]["t_stat"] == pytest.approx(zero["t_stat"], rel=1e-4)
            assert d[k] == d[f"{name}-0"] == want
            assert fits[k]["params"]["ar.L1"] == pytest.approx(fits[f"{name}-0"]["params"]["ar.L1"], abs=1e-4)
            assert fits[k]["params"]["sigma2"] == pytest.approx(fits[f"{name}-0"]["params"]["sigma2"], rel=1e-3)


def test_adf_equals_plain_least_squares(spark):
    x = _arma(300, 0.7, 0.0, 23)
    got = forecast.adf_test(_series(spark, x, "x")).first()
    dy = np.diff(x)

    def fit(p, start):
        t = np.arange(start, len(x))
        X = np.column_stack([np.ones(len(t)), x[t - 1], *[dy[t - 1 - i] for i in range(1, p + 1)]])
        y = dy[t - 1]
        b, *_ = np.linalg.lstsq(X, y, rcond=None)
        sse = ((y - X @ b) ** 2).sum()
        return len(t) * np.log(sse / len(t)) + 2 * (p + 2), b[1] / np.sqrt(sse / (len(t) - p - 2) * np.linalg.inv(X.T @ X)[1, 1])

    most = int(np.ceil(12 * (len(x) / 100) ** 0.25))
    best = min(range(most + 1), key=lambda p: fit(p, most + 1)[0])
    assert got["lags"] == best and got["t_stat"] == pytest.approx(fit(best, best + 1)[1], rel=1e-6)


def test_one_packed_row_a_series_and_batch(spark):
    from pulsegrid.operators.gram import add_packed

    parts = spark.createDataFrame([(f"s{i % 7}", [float(i), 1.0]) for i in range(700)], "series_id string, v array<double>").repartition(5)
    got = {r.series_id: r.v for r in add_packed(parts, ["series_id"]).collect()}
    assert got == {f"s{k}": [float(sum(i for i in range(700) if i % 7 == k)), 100.0] for k in range(7)}


def test_arima_recovers_arma_coefficients(spark):
    df = _series(spark, _arma(3000, 0.6, 0.3, 11), "x")
    m = forecast.arima_fit(df, (1, 0, 1), auto_stationary=False).first()
    assert m["status"] == "ok"
    assert m["params"]["ar.L1"] == pytest.approx(0.6, abs=0.08)
    assert m["params"]["ma.L1"] == pytest.approx(0.3, abs=0.08)
    assert m["aic"] is not None and m["bic"] > m["aic"] - 100


def test_arima_forecast_integrates_back(spark):
    n = 400
    trend = 5.0 + 0.5 * np.arange(n) + 0.01 * _arma(n, 0.3, 0.0, 3)
    df = _series(spark, trend, "t")
    m = forecast.arima_fit(df, (1, 1, 0), auto_stationary=False)
    f = forecast.arima_forecast(m, 10).orderBy("step").collect()
    assert len(f) == 10 and all(r["status"] == "ok" for r in f)
    assert f[0]["forecast"] == pytest.approx(trend[-1] + 0.5, abs=0.2)
    assert f[0]["ts"] == T0 + timedelta(hours=n)
    assert all(r["lo"] <= r["forecast"] <= r["hi"] for r in f)


def test_trend_season_fit_explains_daily_cycle(spark):
    n = 24 * 30
    i = np.arange(n)
    y = 10 + 0.01 * i + 3 * np.sin(2 * np.pi * i / 24) + 0.1 * np.random.default_rng(5).standard_normal(n)
    df = _series(spark, y, "d")
    m = forecast.trend_season_fit(df, yearly=False)
    assert m.first()["status"] == "ok"
    f = forecast.trend_season_forecast(m, 24, history=df).orderBy("step").collect()
    truth = 10 + 0.01 * (n + np.arange(24)) + 3 * np.sin(2 * np.pi * (n + np.arange(24)) / 24)
    err = np.abs(np.asarray([r["forecast"] for r in f]) - truth)
    assert err.mean() < 0.5


def test_iforest_finds_injected_spikes(spark):
    base = panels.user_series(spark, SF_SMALL)
    spiked = columns.inject_spikes(base, 0.05, 20.0, 42).withColumn("value", F.col("value") + F.col("spike"))
    feats = rolling.anomaly_features(spiked.select("series_id", "ts", "seq", "value"))
    nodes = anomaly.iforest_fit(feats, FEATURES, 50, 256, 42)
    scores = anomaly.iforest_score(feats, nodes, FEATURES)
    s = scores.join(spiked.select("series_id", "ts", "seq", F.col("is_spike").alias("lag_src")), ["series_id", "ts", "seq"])
    # a spike enters the features through lag1 one row later; compare average scores
    assert scores.filter(F.col("score").isNull()).count() == 0
    assert 0 < scores.agg(F.min("score")).first()[0] <= scores.agg(F.max("score")).first()[0] < 1
    flagged = anomaly.flag(scores, anomaly.threshold(scores, 0.1))
    share = flagged.agg(F.avg(F.col("anomaly").cast("double"))).first()[0]
    assert 0.05 < share < 0.15
    assert s.count() == scores.count()


def test_inject_spikes_exact_count(spark):
    base = panels.user_series(spark, SF_SMALL)
    got = columns.inject_spikes(base, 0.05, 0.1, 42).groupBy("series_id").agg(F.count_if("is_spike").alias("k"), F.count("*").alias("n"))
    for r in got.collect():
        assert r["k"] == int(0.05 * r["n"])


def test_ensemble_skips_failed_members(spark):
    fc = spark.createDataFrame(
        [("a", "m1", 1, 1.0, "ok"), ("a", "m2", 1, 3.0, "ok"), ("a", "m3", 1, None, "failed")],
        "series_id string, model string, step int, forecast double, status string",
    )
    r = baselines.ensemble(fc, "average").first()
    assert r["forecast"] == 2.0 and r["n_members"] == 2
    with pytest.raises(ValueError):
        baselines.ensemble(fc, "mode")


def test_scaler_zero_std_becomes_one(spark):
    df = frame(spark, [("s", T0 + timedelta(hours=i), i, 1.0) for i in range(3)]).withColumn("f", F.lit(2.0))
    sc = clean.fit_scaler(df, ["f"]).first()
    assert sc["scale"] == 1.0 and sc["mean"] == 2.0


def test_every_series_keeps_a_model_row(spark):
    ok = _series(spark, _arma(300, 0.5, 0.0, 2), "ok")
    short = _series(spark, [1.0, 2.0], "short")
    empty = frame(spark, [("empty", T0, 0, None), ("empty", T0 + timedelta(hours=1), 1, None)])
    df = ok.unionByName(short).unionByName(empty)
    a = {r["series_id"]: r["status"] for r in forecast.arima_fit(df, (1, 0, 0)).collect()}
    assert a == {"ok": "ok", "short": "failed", "empty": "failed"}
    t = {r["series_id"]: r["status"] for r in forecast.trend_season_fit(df, yearly=False).collect()}
    assert t["ok"] == "ok" and t["empty"] == "failed"
    f = forecast.arima_forecast(forecast.arima_fit(df, (1, 0, 0)), 3)
    assert {r["status"] for r in f.filter(F.col("series_id") != "ok").collect()} == {"failed"}


def test_sarima_recovers_seasonal_ar(spark):
    rng = np.random.default_rng(21)
    n, s = 3000, 24
    e = rng.standard_normal(n + 200)
    x = np.zeros(n + 200)
    for t in range(s, n + 200):
        x[t] = 0.6 * x[t - s] + e[t]
    m = forecast.arima_fit(_series(spark, x[200:], "s"), (0, 0, 0), (1, 0, 0, s), auto_stationary=False).first()
    assert m["status"] == "ok"
    assert m["params"]["ar.L24"] == pytest.approx(0.6, abs=0.06)
    assert m["seasonal_order"] == [1, 0, 0, s]


def test_partial_gram_equals_expression_gram(spark, monkeypatch):
    from pulsegrid.operators import gram as G

    rng = np.random.default_rng(4)
    rows_ = [(f"s{i % 3}", *map(float, rng.standard_normal(4))) for i in range(300)]
    df = spark.createDataFrame(rows_, "series_id string, a double, b double, c double, y double")
    monkeypatch.setattr(G, "WIDE", 100)
    narrow = {r["series_id"]: r for r in G.gram(df, ["a", "b", "c"], "y", extra=[F.count("a").alias("m")]).collect()}
    monkeypatch.setattr(G, "WIDE", 1)
    wide = {r["series_id"]: r for r in G.gram(df, ["a", "b", "c"], "y", extra=[F.count("a").alias("m")]).collect()}
    assert set(narrow) == set(wide)
    for k in narrow:
        assert narrow[k]["n"] == wide[k]["n"] and narrow[k]["m"] == wide[k]["m"]
        assert np.allclose(narrow[k]["xtx_u"], wide[k]["xtx_u"]) and np.allclose(narrow[k]["xty"], wide[k]["xty"])
        assert narrow[k]["yty"] == pytest.approx(wide[k]["yty"])


def test_iforest_samples_of_a_long_series(spark):
    """Every tree keeps its smallest hashes; rows travel once, with the trees they pass."""
    feats = rolling.anomaly_features(panels.single_series(spark, SF_SMALL))
    n = feats.count()
    s = anomaly.sample_rows(feats.select("series_id", "ts", "seq", *FEATURES), 20, 32, 42)
    assert s.count() == s.select("ts", "seq").distinct().count() < n
    row, tree = anomaly._samples(s.toPandas(), 20, 32)
    assert (np.bincount(tree, minlength=20) == 32).all()
    assert all(len(set(row[tree == t])) == 32 for t in range(20))
    forest = anomaly.iforest_fit(feats, FEATURES, 20, 32, 42)
    f = forest.first()
    assert f["n_trees"] == 20 and f["psi"] == 32
    scores = anomaly.iforest_score(feats, forest, FEATURES)
    assert scores.count() == n and scores.filter(F.col("score").isNull()).count() == 0


def test_node_sizes_add_up(spark):
    feats = rolling.anomaly_features(panels.user_series(spark, SF_SMALL))
    nodes = anomaly.forest_nodes(anomaly.iforest_fit(feats, FEATURES, 5, 32, 42)).collect()
    size = {(r["series_id"], r["node"]): r["size"] for r in nodes}
    for r in nodes:
        if r["left"] >= 0:
            k = r["series_id"]
            assert r["size"] == size[(k, r["left"])] + size[(k, r["right"])] > 0
        if r["node"] == r["tree"]:
            assert r["size"] == r["psi"]


def test_fit_and_score_in_one_go_equals_two_steps(spark):
    short = rolling.anomaly_features(panels.user_series(spark, SF_SMALL))
    feats = short.unionByName(rolling.anomaly_features(panels.single_series(spark, SF_SMALL)))
    one = {(r["series_id"], r["ts"], r["seq"]): r["score"] for r in anomaly.iforest_scores(feats, FEATURES, 20, 256, 42).collect()}
    two = {(r["series_id"], r["ts"], r["seq"]): r["score"] for r in anomaly.iforest_score(feats, anomaly.iforest_fit(feats, FEATURES, 20, 256, 42), FEATURES).collect()}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)


def test_iforest_scores_do_not_depend_on_chunking(spark):
    feats = rolling.anomaly_features(panels.single_series(spark, SF_SMALL))
    forest = anomaly.iforest_fit(feats, FEATURES, 20, 64, 42)
    one = {(r["ts"], r["seq"]): r["score"] for r in anomaly.iforest_score(feats, forest, FEATURES, chunk_rows=1_000_000).collect()}
    many = {(r["ts"], r["seq"]): r["score"] for r in anomaly.iforest_score(feats, forest, FEATURES, chunk_rows=100).collect()}
    assert one.keys() == many.keys()
    assert all(one[k] == pytest.approx(many[k]) for k in one)


def test_forests_grown_together_equal_each_alone():
    """Ties, constant features, missing values and one-row series: the same nodes and scores as one by one."""
    rng = np.random.default_rng(1)
    sizes = np.asarray([47, 1, 2, 30, 256, 5])
    X = np.round(rng.normal(size=(sizes.sum(), 4)), 1)
    X[48:50], X[60:70, 2], X[-5:, 1] = 1.0, np.nan, 3.0
    limits = np.asarray([anomaly._depth_limit(n) for n in sizes])
    (at, *nodes), paths = anomaly.grow_many(X, sizes, 20, limits, [anomaly._rng(1, str(k)) for k in range(len(sizes))])
    for k, n in enumerate(sizes):
        lo = sizes[:k].sum()
        tree, feature, split, left, _, size = anomaly.grow_forest(np.tile(X[lo : lo + n], (20, 1)), np.repeat(np.arange(20), n), 20, limits[k], anomaly._rng(1, str(k)))
        own = np.flatnonzero(at == k)
        number = {int(g): i for i, g in enumerate(own)} | {-1: -1}
        assert [number[int(g)] for g in nodes[3][own]] == left.tolist()
        for mine, alone in zip((nodes[0], nodes[1], nodes[2], nodes[4]), (tree, feature, split, size)):
            assert np.array_equal(mine[own], alone, equal_nan=True)
        score = np.power(2.0, -(paths[:, lo : lo + n].sum(axis=0) / 20) / max(anomaly._c([n])[0], 1e-12))
        assert np.array_equal(score, anomaly.walk(X[lo : lo + n], feature, split, left, size, 20, n))


def test_a_stored_forest_comes_in_bounded_pieces(spark):
    feats = rolling.anomaly_features(panels.user_series(spark, SF_SMALL)).unionByName(rolling.anomaly_features(panels.single_series(spark, SF_SMALL)))
    forest = anomaly.iforest_fit(feats, FEATURES, 100, 256, 42)
    assert forest.select(F.max(F.size("feature"))).first()[0] <= anomaly.PIECE
    counted = anomaly.forest_nodes(forest).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("node").alias("d"), F.max("node").alias("m")).collect()
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in counted) and any(r["n"] > anomaly.PIECE for r in counted)
