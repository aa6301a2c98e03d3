"""GEN-01..06 column builders on an existing spine; PRJ, FLT and LIM operators."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER, series_window
from pulsegrid.functions.numeric import key_normal, key_uniform
from pulsegrid.operators.stats import attach
from pulsegrid.plans.blocked import apply_windows, rank_within, split_hot, with_ordinal

BASE = [KEY, *ORDER]


def _ord_n(df: DataFrame, plan: str = "auto") -> DataFrame:
    """Adds ``ord`` (0-based position) and ``n`` (rows in the series)."""
    n = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return attach(with_ordinal(df, "ord", plan), n)


def gen_trend(df: DataFrame, strength: float = 0.1, plan: str = "auto") -> DataFrame:
    """GEN-01: linear ramp from 0 to ``strength * n`` over the series (0 for n = 1)."""
    x = _ord_n(df, plan)
    t = F.when(F.col("n") > 1, F.col("ord") * F.lit(strength) * F.col("n") / (F.col("n") - 1)).otherwise(0.0)
    return x.select(*BASE, "value", "ord", t.alias("trend"))


def gen_seasonality(df: DataFrame, strength: float = 0.5, period: int = 24, plan: str = "auto") -> DataFrame:
    """GEN-02: ``a*sin(2*pi*i/p) + 0.3*a*sin(2*pi*i/(7p))``."""
    x = with_ordinal(df, "ord", plan)
    i = F.col("ord").cast("double")
    s = strength * F.sin(2 * math.pi * i / period) + 0.3 * strength * F.sin(2 * math.pi * i / (7 * period))
    return x.select(*BASE, "value", "ord", s.alias("seasonal"))


def add_noise(df: DataFrame, level: float = 0.1, seed: int = 42) -> DataFrame:
    """GEN-03: Gaussian noise of scale ``level`` from the row key (SEM-16)."""
    z = key_normal(seed, "noise")
    return df.select(*BASE, "value", (F.lit(level) * z).alias("noise"))


def inject_spikes(
    df: DataFrame, probability: float = 0.05, level: float = 0.1, seed: int = 42, plan: str = "auto"
) -> DataFrame:
    """GEN-04: exactly ``floor(p * n)`` distinct rows per series get +/-3*level.

    Rows are ranked by a key hash inside the series (``rank_within``: a plain
    window, or hash-range blocks for a very long series) and the first
    ``floor(p * n)`` ranks are picked; the sign comes from a second hash.
    """
    x = df.withColumn("_u", key_uniform(seed, "spike-pick"))
    n = x.groupBy(KEY).agg(F.floor(F.count(F.lit(1)) * F.lit(probability)).cast("long").alias("_k"))
    x = rank_within(x, "_rk", [F.col("_u"), *[F.col(c) for c in ORDER]], plan)
    x = attach(x, n)
    hit = F.col("_rk") < F.col("_k")
    sign = F.when(key_uniform(seed, "spike-sign") < 0.5, -3.0).otherwise(3.0)
    return x.select(*BASE, "value", hit.alias("is_spike"), F.when(hit, sign * level).otherwise(0.0).alias("spike"))


def compose_components(
    df: DataFrame,
    trend_strength: float = 0.1,
    seasonality_strength: float = 0.5,
    noise_level: float = 0.1,
    anomaly_probability: float = 0.05,
    period: int = 24,
    seed: int = 42,
    plan: str = "auto",
) -> DataFrame:
    """GEN-05: synthetic value = trend + season + noise + spike on the rows of ``df``."""
    t = gen_trend(df, trend_strength, plan).select(*BASE, "ord", "trend")
    i = F.col("ord").cast("double")
    a = seasonality_strength
    season = a * F.sin(2 * math.pi * i / period) + 0.3 * a * F.sin(2 * math.pi * i / (7 * period))
    noise = noise_level * key_normal(seed, "noise")
    sp = inject_spikes(df, anomaly_probability, noise_level, seed, plan).select(*BASE, "is_spike", "spike")
    x = t.join(sp, BASE).select(*BASE, "trend", season.alias("seasonal"), noise.alias("noise"), "spike", "is_spike")
    return x.withColumn("value", F.col("trend") + F.col("seasonal") + F.col("noise") + F.col("spike"))


def gen_sine(df: DataFrame, cycles_pi: float = 10.0, plan: str = "auto") -> DataFrame:
    """GEN-06: ``sin(linspace(0, cycles_pi*pi, n))`` along each series."""
    x = _ord_n(df, plan)
    phase = F.when(F.col("n") > 1, F.col("ord") * F.lit(cycles_pi * math.pi) / (F.col("n") - 1)).otherwise(0.0)
    return x.select(*BASE, "ord", F.sin(phase).alias("sine"))


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PRJ-01."""
    return df.dropna(subset=cols or ["value"])


def difference(df: DataFrame, order: int = 1, col: str = "value", plan: str = "auto") -> DataFrame:
    """PRJ-02: ``value - lag(value)`` repeated ``order`` times, NULL rows dropped each time."""
    if order < 0:
        raise ValueError("order must be >= 0")
    x = df.select(*BASE, F.col(col).alias("value"))

    def build(d: DataFrame, part) -> DataFrame:
        w = series_window(*part)
        keep = [c for c in d.columns if c.startswith("_")]
        return d.select(*BASE, *keep, (F.col("value") - F.lag("value", 1).over(w)).alias("value"))

    def passes(part: DataFrame, how: str) -> DataFrame:
        for _ in range(order):
            part = apply_windows(part, build, lookback=1, plan=how).filter(F.col("value").isNotNull())
        return part

    return reduce(DataFrame.unionByName, (passes(part, how) for part, how in split_hot(x, plan))) if order else x


def row_ordinal(df: DataFrame, plan: str = "auto") -> DataFrame:
    """PRJ-04."""
    return with_ordinal(df, "ord", plan)


def train_test_split(df: DataFrame, train_fraction: float = 0.8, plan: str = "auto") -> DataFrame:
    """FLT-01: the first ``floor(0.8 n)`` rows of each series are ``train``."""
    x = _ord_n(df, plan)
    cut = F.floor(F.col("n") * F.lit(train_fraction))
    return x.select(*BASE, "value", "ord", F.when(F.col("ord") < cut, "train").otherwise("test").alias("split"))


def split_by_flag(df: DataFrame, flags: DataFrame, flag: str = "anomaly") -> DataFrame:
    """FLT-02 / JOI-02: label rows normal/anomalous by a left join of the flags (SEM-12)."""
    f = flags.select(*BASE, F.col(flag).alias("_f"))
    x = df.join(f, BASE, "left")
    return x.select(
        *[c for c in df.columns], F.when(F.coalesce(F.col("_f"), F.lit(False)), "anomalous").otherwise("normal").alias("part")
    )


def head_per_series(df: DataFrame, k: int = 10) -> DataFrame:
    """LIM-01: first k rows of each series (a top-k report, the limit is the feature)."""
    rn = F.row_number().over(series_window())
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= k).drop("_rn")


def tail_per_series(df: DataFrame, k: int = 10) -> DataFrame:
    """LIM-02: last k rows of each series."""
    w = Window.partitionBy(KEY).orderBy(*[F.col(c).desc() for c in ORDER])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def head(df: DataFrame, k: int = 10) -> DataFrame:
    """LIM-01 (global): first k rows in (series_id, ts, seq) order; top-k, no full sort."""
    return df.orderBy(*BASE).limit(k)
