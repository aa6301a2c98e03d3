"""AGG-01..07 and MET-01: per-series aggregates (partial + final aggregation).

Per-series scalars are joined back with a ``groupBy`` + join (``attach``), never
with an unordered window, so a huge series is not pulled into one task: the
aggregate is map-side combined, and the join is broadcast when the scalar table
is small or split by AQE's skew-join handling when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER
from pulsegrid.functions.numeric import adjusted_kurtosis, adjusted_skewness, safe_div
from pulsegrid.operators.quantiles import quantiles
from pulsegrid.plans.blocked import choose_plan, split_hot


def attach(df: DataFrame, scalars: DataFrame, on: Sequence[str] = (KEY,)) -> DataFrame:
    """JOI-04: per-series scalars joined back to the rows. No broadcast hint: the
    scalar table grows with the number of series, so Spark broadcasts it only when
    its measured size is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise a
    sort-merge join, whose hot-key partitions AQE splits (left side of a left join)."""
    return df.join(scalars, list(on), "left")


def summary_stats(df: DataFrame, col: str = "value", by: Sequence[str] = (KEY,)) -> DataFrame:
    """AGG-01: count, mean, sample std, min, max, adjusted skewness and excess kurtosis."""
    v = F.col(col)
    n = F.count(v)
    return df.groupBy(*by).agg(
        n.alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        adjusted_skewness(v, n).alias("skew"),
        adjusted_kurtosis(v, n).alias("kurtosis"),
    )


def iqr_bounds(df: DataFrame, factor: float = 1.5, col: str = "value", approx: bool = False, plan: str = "auto") -> DataFrame:
    """AGG-02: quartiles (linear interpolation), IQR and the outlier fences.

    Exact by default (``quantiles``: one map-merging aggregate, or level-wise
    refinement for a very long series); ``approx=True`` uses ``percentile_approx``."""
    v = F.col(col)
    if approx:
        b = df.groupBy(KEY).agg(F.percentile_approx(v, [0.25, 0.75], 10000).alias("_q"))
    else:
        b = quantiles(df, [0.25, 0.75], col, plan).withColumnRenamed("q", "_q")
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    return b.select(
        KEY,
        q1.alias("q1"),
        q3.alias("q3"),
        (q3 - q1).alias("iqr"),
        (q1 - factor * (q3 - q1)).alias("lower"),
        (q3 + factor * (q3 - q1)).alias("upper"),
    )


def median_mad(df: DataFrame, col: str = "value", plan: str = "auto") -> DataFrame:
    """AGG-03: median and unscaled median absolute deviation (two passes; NULLs skipped)."""
    v = F.col(col)
    plan = choose_plan(df, plan)
    med = quantiles(df, [0.5], col, plan).select(KEY, F.col("q")[0].alias("median"))
    dev = attach(df.select(KEY, v.alias("_v")), med).select(KEY, F.abs(F.col("_v") - F.col("median")).alias("_d"))
    mad = quantiles(dev, [0.5], "_d", plan).select(KEY, F.col("q")[0].alias("mad"))
    return med.join(mad, KEY, "left")


def histogram(df: DataFrame, bins: int = 50, col: str = "value") -> DataFrame:
    """AGG-04: equal-width histogram between each series' min and max.

    The top edge goes into the last bin; a constant series is one bin.
    """
    v = F.col(col)
    rng = df.groupBy(KEY).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    x = attach(df.select(KEY, v.alias("_v")).filter(F.col("_v").isNotNull()), rng)
    width = F.col("hi") - F.col("lo")
    raw = F.floor((F.col("_v") - F.col("lo")) / width * F.lit(bins)).cast("long") + 1
    b = F.when(width == 0, F.lit(1).cast("long")).otherwise(F.least(F.lit(bins).cast("long"), raw))
    counts = x.groupBy(KEY, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return counts.select(
        KEY,
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * step).alias("bin_lo"),
        (F.col("lo") + F.col("bin") * step).alias("bin_hi"),
        "count",
    )


def acf(df: DataFrame, nlags: int = 50, col: str = "value", plan: str = "auto") -> DataFrame:
    """AGG-05: biased autocorrelation, lags 0..nlags, after dropping NULLs.

    Lag products of whole runs (``runs``), one array a series, stacked to long form. Rows only
    for lags below the series length.
    """
    clean = df.select(KEY, *ORDER, F.col(col).alias("value")).filter(F.col("value").isNotNull())
    return reduce(DataFrame.unionByName, (_acf(part, nlags, how) for part, how in split_hot(clean, plan)))


def _acf(clean: DataFrame, nlags: int, plan: str) -> DataFrame:
    from pulsegrid.operators.runs import lag_products, series_scale, stream, summed

    heads = series_scale(clean).select(KEY, "_n", F.lit(nlags).alias("_reach"), F.array(F.col("_n").cast("double"), "_mean").alias("_head"))

    def sums(head, first, before, x):
        return [head[0] if first + before == 0 else 0.0, *lag_products(x - head[1], before, nlags)]

    found = summed(stream(clean, heads, plan), sums, plan)
    v = F.col("v")
    long = found.select(KEY, v[0].alias("_n"), v[1].alias("_den"), F.posexplode(F.slice(v, 2, nlags + 1)).alias("lag", "_s"))
    return long.where(F.col("lag") < F.col("_n")).select(KEY, "lag", safe_div(F.col("_s"), F.col("_den")).alias("acf"))


def anomaly_rate(flags: DataFrame, flag: str = "anomaly") -> DataFrame:
    """AGG-06: anomaly count and rate in percent of all rows (SEM-14); also rows scored."""
    f = F.col(flag)
    return flags.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(f).alias("n_scored"),
        F.count_if(F.coalesce(f, F.lit(False))).alias("n_anomalies"),
    ).withColumn("rate_pct", safe_div(F.col("n_anomalies") * 100.0, F.col("n").cast("double")))


def forecast_metrics(actual: DataFrame, forecasts: DataFrame) -> DataFrame:
    """MET-01: MAE, MSE, RMSE per (series, model) on steps present on both sides (SEM-13).

    ``actual``: series_id, step, actual; ``forecasts``: series_id, model, step, forecast.
    """
    j = forecasts.join(actual, [KEY, "step"], "inner").filter(
        F.col("actual").isNotNull() & F.col("forecast").isNotNull()
    )
    e = F.col("forecast") - F.col("actual")
    m = j.groupBy(KEY, "model").agg(
        F.count(F.lit(1)).alias("n_compared"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse")
    )
    return m.withColumn("rmse", F.sqrt("mse"))


def count_models(models: DataFrame) -> DataFrame:
    """AGG-07: fitted model count per model kind."""
    return models.groupBy("model").agg(F.count_if(F.col("status") == "ok").alias("n_fitted"))

