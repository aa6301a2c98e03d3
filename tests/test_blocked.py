"""The blocked plan (for one very long series) gives exactly the plain plan's result."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from pulsegrid.operators import clean, columns, decompose, rolling, runs, stats
from pulsegrid.plans import blocked
from pulsegrid.sources import panels


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocked, "BLOCK_ROWS", 64)


def _long(spark):
    return panels.single_series(spark, SF_SMALL)


def _masked(spark):
    return panels.masked(panels.user_series(spark, SF_SMALL))


CASES = {
    "ordinal": lambda df, plan: blocked.with_ordinal(df, "ord", plan),
    "rolling": lambda df, plan: rolling.rolling_stats(df, 30, plan=plan),
    "rolling_full": lambda df, plan: rolling.rolling_full(df, plan=plan),
    "features": lambda df, plan: rolling.anomaly_features(df, plan=plan),
    "band": lambda df, plan: rolling.rolling_band(df, 20, plan=plan),
    "cma": lambda df, plan: rolling.centered_ma(df, 24, plan=plan),
    "lags": lambda df, plan: rolling.lags(df, (1, 5), plan=plan),
    "diff2": lambda df, plan: columns.difference(df, 2, plan=plan),
    "acf": lambda df, plan: stats.acf(df, 10, plan=plan),
    "decompose": lambda df, plan: decompose.decompose(df, 24, plan=plan),
    **{f"interp_{m}": (lambda m: lambda df, plan: clean.interpolate(df, m, plan=plan))(m) for m in ("linear", "time", "ffill", "bfill", "nearest")},
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_blocked_equals_plain_long_series(spark, small_blocks, case):
    df = panels.masked(_long(spark))
    fn = CASES[case]
    assert rows(fn(df, "blocked")) == rows(fn(df, "plain"))


@pytest.mark.parametrize("case", ["rolling", "interp_linear", "ordinal", "features"])
def test_blocked_equals_plain_many_series(spark, small_blocks, case):
    df = _masked(spark)
    assert rows(CASES[case](df, "blocked")) == rows(CASES[case](df, "plain"))


def test_blocked_uses_more_than_one_block(spark, small_blocks):
    x = blocked.blocked_ordinal(_long(spark), 64, "ord")
    n = x.count()
    assert x.select(F.max("ord")).first()[0] == n - 1
    assert x.select("ord").distinct().count() == n


def test_auto_plan_switches_on_size(spark, monkeypatch):
    df = _long(spark)
    assert blocked.choose_plan(df, "auto") == "plain"
    monkeypatch.setattr(blocked, "HOT_ROWS", 10)
    blocked._plan_cache.clear()
    assert blocked.choose_plan(df, "auto") == "blocked"
    blocked._plan_cache.clear()


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_partition_invariance(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = _masked(spark)
        got = rows(rolling.rolling_stats(df, 30, plan="plain"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == rows(rolling.rolling_stats(_masked(spark), 30, plan="plain"))


def test_blocked_spike_rank_equals_plain(spark, small_blocks):
    df = _masked(spark)
    a = columns.inject_spikes(df, 0.05, 0.1, 42, plan="blocked")
    b = columns.inject_spikes(df, 0.05, 0.1, 42, plan="plain")
    assert rows(a) == rows(b)


def test_blocked_adf_equals_plain(spark, small_blocks):
    from pulsegrid.operators import forecast

    df = panels.user_series(spark, SF_SMALL)
    a = forecast.auto_difference(df, plan="blocked").select("series_id", "d")
    b = forecast.auto_difference(df, plan="plain").select("series_id", "d")
    assert rows(a) == rows(b)
    ta = forecast.adf_test(_long(spark), plan="blocked")
    tb = forecast.adf_test(_long(spark), plan="plain")
    assert rows(ta, digits=6) == rows(tb, digits=6)


@pytest.mark.parametrize("src", ["long", "panel"])
def test_blocked_exact_quantiles_equal_percentile(spark, src):
    from pulsegrid.operators import quantiles

    df = panels.masked(_long(spark)) if src == "long" else _masked(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    a = quantiles.quantiles(df, probs, plan="blocked", max_sort_rows=40, fanout=8)
    b = quantiles.quantiles(df, probs, plan="plain")
    assert rows(a) == rows(b)


def test_blocked_median_mad_and_iqr(spark, small_blocks):
    df = panels.masked(_long(spark))
    assert rows(stats.median_mad(df, plan="blocked")) == rows(stats.median_mad(df, plan="plain"))
    assert rows(stats.iqr_bounds(df, plan="blocked")) == rows(stats.iqr_bounds(df, plan="plain"))


def test_blocked_arima_equals_plain(spark, monkeypatch):
    from pulsegrid.operators import forecast

    monkeypatch.setattr(blocked, "BLOCK_ROWS", 256)
    df = panels.masked(_long(spark)).filter(F.col("value").isNotNull())
    ma = forecast.arima_fit(df, (1, 1, 1), plan="blocked")
    mb = forecast.arima_fit(df, (1, 1, 1), plan="plain")
    a, b = ma.first(), mb.first()
    assert a["status"] == b["status"] == "ok"
    assert a["n"] == b["n"]
    for k, v in b["params"].items():
        assert a["params"][k] == pytest.approx(v, rel=1e-9, abs=1e-12)
    fa = forecast.arima_forecast(ma, 5).orderBy("step").collect()
    fb = forecast.arima_forecast(mb, 5).orderBy("step").collect()
    assert [r["ts"] for r in fa] == [r["ts"] for r in fb]
    assert [r["forecast"] for r in fa] == pytest.approx([r["forecast"] for r in fb])


def test_blocked_quantiles_keep_all_null_series(spark):
    from datetime import datetime

    from conftest import frame
    from pulsegrid.operators import quantiles

    t0 = datetime(2024, 1, 1)
    df = frame(spark, [("a", t0, i, float(i)) for i in range(10)] + [("b", t0, i, None) for i in range(3)])
    a = quantiles.quantiles(df, [0.5], plan="blocked", max_sort_rows=4, fanout=4)
    b = quantiles.quantiles(df, [0.5], plan="plain")
    assert rows(a) == rows(b)


def _bursty(spark, kind):
    """20,000 rows: nine tenths in one minute of a year, or all at one time."""
    from pyspark.sql import functions as F

    ts = F.timestamp_seconds(F.lit(1_700_000_000) + (F.when(F.col("id") % 10 == 0, F.col("id") * 1500).otherwise(F.col("id") % 60) if kind == "burst" else F.lit(0)))
    return spark.range(20_000).select(F.lit("a").alias("series_id"), ts.cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"), (F.col("id") % 97).cast("double").alias("value"))


@pytest.mark.parametrize("kind", ["burst", "tied"])
def test_bursts_and_ties_are_split(spark, kind):
    from pulsegrid.plans.lineage import materialize

    df = materialize(_bursty(spark, kind))
    largest = blocked._bucketed(df, 1000, ["ts", "seq"]).groupBy("series_id", "__tb").count().agg({"count": "max"}).first()[0]
    assert largest <= 2000
    with blocked.forced_blocks(1000):
        a = rolling.rolling_stats(df, 30, plan="blocked")
    assert rows(a) == rows(rolling.rolling_stats(df, 30, plan="plain"))


def _mixed(spark):
    """One long series beside the users' short ones and a null series."""
    x = panels.masked(_long(spark)).unionByName(_masked(spark))
    return x.withColumn("series_id", F.when(F.col("series_id") != "3", F.col("series_id")))


@pytest.mark.parametrize("case", sorted(CASES))
def test_only_hot_series_are_blocked(spark, small_blocks, monkeypatch, case):
    df = _mixed(spark)
    longest = df.groupBy("series_id").count().where("series_id <> 'all' or series_id is null").agg({"count": "max"}).first()[0]
    monkeypatch.setattr(blocked, "HOT_ROWS", longest + 1)
    taken = []
    ordinal = blocked.blocked_ordinal
    for module in (blocked, runs):
        monkeypatch.setattr(module, "blocked_ordinal", lambda part, *a, **k: taken.append(part) or ordinal(part, *a, **k))
    blocked._plan_cache.clear()
    got = rows(CASES[case](df, "auto"))
    blocked._plan_cache.clear()
    assert taken
    assert {r[0] for part in taken for r in part.select("series_id").distinct().collect()} <= {"all"}
    assert got == rows(CASES[case](df, "plain"))


def test_split_keeps_a_null_series(spark, monkeypatch):
    df = _mixed(spark)
    for hot in (1, 10**9):
        parts = blocked.split_hot(df, "auto", hot)
        assert sum(part.count() for part, _ in parts) == df.count()
    blocked._plan_cache.clear()


def test_job_tables_are_deleted(spark):
    import os
    import threading

    from pulsegrid.plans.lineage import job_tables, materialize
    from pulsegrid.session import local_path

    made = lambda: materialize(spark.range(3))
    kept = made()
    other: list[str] = []

    def beside():
        with job_tables(spark) as mine:
            made()
            other.extend(mine)

    with pytest.raises(ZeroDivisionError), job_tables(spark) as outer:
        made()
        with job_tables(spark) as inner:
            made()
            assert os.path.isdir(local_path(inner[0]))
        assert not os.path.exists(local_path(inner[0])) and os.path.isdir(local_path(outer[0]))
        run = threading.Thread(target=beside)
        run.start()
        run.join()
        assert len(outer) == len(inner) == len(other) == 1 and not os.path.exists(local_path(other[0]))
        1 / 0
    assert not os.path.exists(local_path(outer[0]))
    assert kept.count() == 3


def test_small_blocks_take_a_bounded_number_of_ranges(spark):
    df = _masked(spark)
    assert 2 * df.count() // 8 > blocked.RANGES  # so many half blocks there are
    ranges = blocked._bucketed(df, 8, blocked.ORDER).select("__tb").distinct().count()
    assert 1 < ranges <= blocked.RANGES
    with blocked.forced_blocks(8):
        assert rows(clean.interpolate(df, "linear", plan="blocked")) == rows(clean.interpolate(df, "linear", plan="plain"))
