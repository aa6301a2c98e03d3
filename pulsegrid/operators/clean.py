"""OUT-01..03, IMP-01..05, NRM-01..04: outliers, imputation and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER
from pulsegrid.functions.numeric import safe_div
from pulsegrid.operators.stats import attach, iqr_bounds, median_mad
from pulsegrid.plans.blocked import carry_fill, epoch_micros

BASE = [KEY, *ORDER]


def outlier_iqr(df: DataFrame, factor: float = 1.5, col: str = "value") -> DataFrame:
    """OUT-01: flag ``v < Q1 - f*IQR or v > Q3 + f*IQR``; missing -> false."""
    b = iqr_bounds(df, factor, col).select(KEY, "lower", "upper")
    v = F.col(col)
    x = attach(df, b)
    flag = F.coalesce((v < F.col("lower")) | (v > F.col("upper")), F.lit(False))
    return x.withColumn("outlier", flag).drop("lower", "upper")


def outlier_zscore(df: DataFrame, threshold: float = 3.0, col: str = "value") -> DataFrame:
    """OUT-02: flag ``|v - mean| > threshold * sample std``; missing -> false."""
    v = F.col(col)
    s = df.groupBy(KEY).agg(F.avg(v).alias("_mu"), F.stddev_samp(v).alias("_sd"))
    flag = F.coalesce(F.abs(v - F.col("_mu")) > threshold * F.col("_sd"), F.lit(False))
    return attach(df, s).withColumn("outlier", flag).drop("_mu", "_sd")


def remove_outliers(df: DataFrame, method: str = "iqr", col: str = "value", **kw) -> DataFrame:
    """OUT-03 + PRJ-03: flagged values become NULL; unknown method -> ValueError."""
    if method == "iqr":
        flagged = outlier_iqr(df, kw.get("factor", 1.5), col)
    elif method == "zscore":
        flagged = outlier_zscore(df, kw.get("threshold", 3.0), col)
    else:
        raise ValueError(f"Unknown outlier detection method: {method}")
    return mask_flagged(flagged, "outlier", col).drop("outlier")


def mask_flagged(df: DataFrame, flag: str, col: str = "value") -> DataFrame:
    """PRJ-03: ``value`` becomes NULL where ``flag`` is true."""
    return df.withColumn(col, F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col(col)))


INTERP_METHODS = ("linear", "time", "index", "values", "pad", "ffill", "bfill", "backfill", "nearest")


def interpolate(df: DataFrame, method: str = "linear", col: str = "value", plan: str = "auto") -> DataFrame:
    """IMP-01..05. Positional ``linear`` leaves leading gaps and carries the last
    value into trailing gaps; ``time``, ``index`` and ``values`` weigh by timestamp, the
    index of a series; ``ffill``/``bfill`` carry; ``nearest`` takes the value nearest in
    time and fills inner gaps only (tie -> earlier row)."""
    if method not in INTERP_METHODS:
        raise ValueError(f"Unknown interpolation method: {method}")
    x = carry_fill(df.select(*BASE, F.col(col).alias("value")), "value", plan=plan)
    v = F.col("value")
    pv, po, nv, no = (F.col(c) for c in ("_prev_v", "_prev_o", "_next_v", "_next_o"))
    if method in ("linear", "index", "values", "time"):
        if method != "linear":
            pos = epoch_micros("ts").cast("double")
            ppos, npos = F.col("_prev_t").cast("double"), F.col("_next_t").cast("double")
        else:
            pos, ppos, npos = F.col("ord").cast("double"), po.cast("double"), no.cast("double")
        inner = pv + (nv - pv) * safe_div(pos - ppos, npos - ppos)
        filled = F.when(v.isNotNull(), v).when(pv.isNotNull() & nv.isNotNull(), F.coalesce(inner, pv)).when(
            pv.isNotNull(), pv
        )
    elif method in ("pad", "ffill"):
        filled = F.coalesce(v, pv)
    elif method in ("bfill", "backfill"):
        filled = F.coalesce(v, nv)
    else:  # nearest
        t = epoch_micros("ts")
        near = F.when((t - F.col("_prev_t")) <= (F.col("_next_t") - t), pv).otherwise(nv)
        filled = F.when(v.isNotNull(), v).when(pv.isNotNull() & nv.isNotNull(), near)
    return x.select(*BASE, filled.alias(col))


def normalize(df: DataFrame, method: str = "zscore", col: str = "value") -> DataFrame:
    """NRM-01..03: zscore (sample std), minmax, robust (median/unscaled MAD).

    A zero divisor gives NULL (SEM-6); unknown method -> ValueError.
    """
    v = F.col(col)
    if method == "zscore":
        s = df.groupBy(KEY).agg(F.avg(v).alias("_a"), F.stddev_samp(v).alias("_b"))
        out = safe_div(v - F.col("_a"), F.col("_b"))
    elif method == "minmax":
        s = df.groupBy(KEY).agg(F.min(v).alias("_a"), F.max(v).alias("_m"))
        s = s.select(KEY, "_a", (F.col("_m") - F.col("_a")).alias("_b"))
        out = safe_div(v - F.col("_a"), F.col("_b"))
    elif method == "robust":
        s = median_mad(df, col).select(KEY, F.col("median").alias("_a"), F.col("mad").alias("_b"))
        out = safe_div(v - F.col("_a"), F.col("_b"))
    else:
        raise ValueError(f"Unknown normalization method: {method}")
    return attach(df, s).withColumn(col, out).drop("_a", "_b")


def fit_scaler(features: DataFrame, cols: list[str]) -> DataFrame:
    """NRM-04 fit: per-series mean and population std per feature (zero std -> 1),
    stored as a long model table ``(series_id, feature, mean, scale)``."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s")]
    wide = features.groupBy(KEY).agg(*aggs)
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"{c}__m").alias("mean"),
                F.when(F.col(f"{c}__s") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__s")).alias("scale"),
            )
            for c in cols
        ]
    )
    return wide.select(KEY, F.explode(entries).alias("e")).select(KEY, "e.*")


def apply_scaler(features: DataFrame, scaler: DataFrame, cols: list[str]) -> DataFrame:
    """NRM-04 transform with the stored per-series mean/scale."""
    wide = scaler.groupBy(KEY).agg(
        *[F.max(F.when(F.col("feature") == c, F.struct("mean", "scale"))).alias(f"{c}__p") for c in cols]
    )
    x = attach(features, wide)
    return x.select(
        *[c for c in features.columns if c not in cols],
        *[((F.col(c) - F.col(f"{c}__p.mean")) / F.col(f"{c}__p.scale")).alias(c) for c in cols],
    )
