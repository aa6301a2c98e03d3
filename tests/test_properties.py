"""Properties from the reference's own tests, plus edge fixtures (FIXTURES.md)."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import frame, rows
from pulsegrid.frame import canonical
from pulsegrid.operators import clean, rolling, stats

T0 = datetime(2023, 1, 1)


def series(spark, values, sid="s", start=T0, step=timedelta(hours=1)):
    data = [(sid, start + i * step, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return frame(spark, data)


def test_rolling_current_and_keys(spark):
    df = rolling.rolling_stats(series(spark, [1, 2, 3, 4, 5]), 10)
    got = df.orderBy("ts").collect()
    assert [r["current"] for r in got] == [1, 2, 3, 4, 5]
    assert [r["window_size"] for r in got] == [1, 2, 3, 4, 5]
    assert got[-1]["mean"] == 3.0
    assert got[-1]["std"] == pytest.approx(np.std([1, 2, 3, 4, 5]))
    assert got[-1]["median"] == 3.0


def test_rolling_window_cap(spark):
    df = rolling.rolling_stats(series(spark, list(range(20))), 10)
    last = df.orderBy(F.col("ts").desc()).first()
    assert last["window_size"] == 10
    assert last["min"] == 10 and last["max"] == 19
    assert last["mean"] == pytest.approx(np.mean(range(10, 20)))


def test_rolling_null_inside_buffer_voids_stats_until_it_leaves(spark):
    vals = [1, 2, None, 4, 5, 6]
    got = rolling.rolling_stats(series(spark, vals), 3).orderBy("ts").collect()
    assert [r["mean"] is None for r in got] == [False, False, True, True, True, False]
    assert got[-1]["mean"] == 5.0


def test_full_warmup(spark):
    got = rolling.rolling_stats(series(spark, [1, 2, 3, 4]), 3, warmup="full").orderBy("ts").collect()
    assert [r["mean"] for r in got] == [None, None, 2.0, 3.0]


def test_iqr_flags_are_boolean_and_catch_extremes(spark):
    rng = np.random.default_rng(42)
    vals = list(rng.standard_normal(90)) + [10, -10, 15, -15]
    df = clean.outlier_iqr(series(spark, vals))
    flagged = {r["value"] for r in df.filter("outlier").collect()}
    assert {10.0, -10.0, 15.0, -15.0} <= flagged
    assert dict(df.dtypes)["outlier"] == "boolean"


def test_remove_then_interpolate_leaves_no_inner_nulls(spark):
    rng = np.random.default_rng(1)
    vals = list(rng.standard_normal(90)) + [10, -10, 15, -15]
    vals[10:15] = [None] * 5
    x = clean.interpolate(clean.remove_outliers(series(spark, vals), "iqr"), "linear")
    assert x.filter(F.col("value").isNull()).count() == 0


def test_zscore_and_minmax(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    z = [r["value"] for r in clean.normalize(series(spark, vals), "zscore").collect()]
    assert np.mean(z) == pytest.approx(0, abs=1e-12) and np.std(z, ddof=1) == pytest.approx(1)
    m = [r["value"] for r in clean.normalize(series(spark, vals), "minmax").collect()]
    assert min(m) == 0 and max(m) == 1


def test_robust_matches_numpy(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    got = sorted(r["value"] for r in clean.normalize(series(spark, vals), "robust").collect())
    med = np.median(vals)
    mad = np.median(np.abs(np.asarray(vals) - med))
    assert got == pytest.approx(sorted((np.asarray(vals) - med) / mad))


def test_unknown_methods_raise(spark):
    df = series(spark, [1, 2, 3])
    with pytest.raises(ValueError):
        clean.remove_outliers(df, "nope")
    with pytest.raises(ValueError):
        clean.normalize(df, "nope")
    with pytest.raises(ValueError):
        clean.interpolate(df, "nope")


def test_constant_series_zero_divisor_is_null(spark):
    df = series(spark, [2.0] * 6)
    assert clean.normalize(df, "zscore").filter(F.col("value").isNotNull()).count() == 0
    assert clean.normalize(df, "minmax").filter(F.col("value").isNotNull()).count() == 0
    h = stats.histogram(df, 50).collect()
    assert len(h) == 1 and h[0]["count"] == 6


def test_edge_series(spark):
    one = series(spark, [1.0], sid="one")
    two = series(spark, [1.0, 3.0], sid="two")
    nul = series(spark, [None, None, None], sid="null")
    df = one.unionByName(two).unionByName(nul)
    s = {r["series_id"]: r for r in stats.summary_stats(df).collect()}
    assert s["one"]["std"] is None and s["two"]["std"] == pytest.approx(np.std([1, 3], ddof=1))
    assert s["null"]["count"] == 0 and s["null"]["mean"] is None
    assert s["two"]["skew"] is None
    lin = {r["series_id"]: r["value"] for r in clean.interpolate(df, "linear").collect()}
    assert lin["null"] is None


def test_interpolation_gaps_at_both_ends(spark):
    df = series(spark, [None, 1.0, None, None, 4.0, None])
    got = [r["value"] for r in clean.interpolate(df, "linear").orderBy("ts").collect()]
    assert got == [None, 1.0, 2.0, 3.0, 4.0, 4.0]
    ff = [r["value"] for r in clean.interpolate(df, "ffill").orderBy("ts").collect()]
    assert ff == [None, 1.0, 1.0, 1.0, 4.0, 4.0]
    bf = [r["value"] for r in clean.interpolate(df, "bfill").orderBy("ts").collect()]
    assert bf == [1.0, 1.0, 4.0, 4.0, 4.0, None]
    nn = [r["value"] for r in clean.interpolate(df, "nearest").orderBy("ts").collect()]
    assert nn == [None, 1.0, 1.0, 4.0, 4.0, None]


def test_time_interpolation_uses_spacing(spark):
    data = [("s", T0, 0, 0.0), ("s", T0 + timedelta(hours=1), 1, None), ("s", T0 + timedelta(hours=4), 2, 4.0)]
    got = [r["value"] for r in clean.interpolate(frame(spark, data), "time").orderBy("ts").collect()]
    assert got == [0.0, 1.0, 4.0]


def test_equal_ts_ordered_by_seq(spark):
    data = [("s", T0, 2, 20.0), ("s", T0, 1, 10.0)]
    got = rolling.lags(frame(spark, data)).orderBy("seq").collect()
    assert got[0]["lag1"] is None and got[1]["lag1"] == 10.0


def test_nan_and_inf_become_null_on_ingest(spark):
    df = spark.createDataFrame([("s", T0, 0, float("nan")), ("s", T0, 1, float("inf")), ("s", T0, 2, 1.0)], "series_id string, ts timestamp_ntz, seq long, value double")
    c = canonical(df, seq="seq")
    assert c.filter(F.col("value").isNull()).count() == 2


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = list(np.cumsum(rng.standard_normal(200)))
    got = {r["lag"]: r["acf"] for r in stats.acf(series(spark, vals), 5).collect()}
    x = np.asarray(vals) - np.mean(vals)
    den = x @ x
    for k in range(6):
        assert got[k] == pytest.approx((x[k:] @ x[: len(x) - k]) / den)


def test_skew_kurtosis_match_pandas(spark):
    import pandas as pd

    vals = [1.0, 2.0, 2.5, 7.0, 3.0, 11.0, 0.5]
    r = stats.summary_stats(series(spark, vals)).first()
    assert r["skew"] == pytest.approx(pd.Series(vals).skew())
    assert r["kurtosis"] == pytest.approx(pd.Series(vals).kurt())


def test_decomposition_recovers_season(spark):
    n, m = 24 * 8, 24
    i = np.arange(n)
    vals = list(0.05 * i + 2 * np.sin(2 * np.pi * i / m))
    d = rows(__import__("pulsegrid.operators.decompose", fromlist=["x"]).decompose(series(spark, vals), m), ["ts", "seasonal", "trend"])
    seas = [s for _, s, _ in d]
    assert max(seas) == pytest.approx(2, abs=0.05)


def test_period_longer_than_half_the_series_gives_null_components(spark):
    from pulsegrid.operators import decompose as dec

    got = dec.decompose(series(spark, list(np.sin(np.arange(30)))), 24).collect()
    assert len(got) == 30
    assert all(r["trend"] is None and r["seasonal"] is None and r["resid"] is None for r in got)
