"""Column-level numeric helpers; all stay JVM-side (codegen), no Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero divisor (SEM-6; ANSI mode would raise)."""
    return F.try_divide(num, den)


def adjusted_skewness(c: Column, n: Column) -> Column:
    """Bias-adjusted sample skewness G1 from Spark's population ``skewness`` (SEM-5)."""
    n = n.cast("double")
    g1 = F.skewness(c)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(c: Column, n: Column) -> Column:
    """Bias-adjusted excess kurtosis G2 from Spark's population ``kurtosis`` (SEM-5)."""
    n = n.cast("double")
    g2 = F.kurtosis(c)
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


# Abramowitz and Stegun 26.2.17, error below 7.5e-8
CDF = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
CDF_STEP = 0.2316419


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function (polynomial approximation, error below 7.5e-8)."""
    k = 1.0 / (1.0 + CDF_STEP * F.abs(x))
    poly = F.lit(0.0)
    for c in reversed(CDF):
        poly = (poly + c) * k
    upper = F.exp(-x * x / 2.0) / math.sqrt(2.0 * math.pi) * poly
    return F.when(x >= 0, 1.0 - upper).otherwise(upper)


def hash_uniform(seed: int, *parts: Column | str, salt: str = "") -> Column:
    """Counter-based uniform in [0, 1) from xxhash64 (SEM-16).

    Depends only on the seed and the row's key columns, so it is the same for any
    partitioning, retry or executor loss (``F.rand`` is not).
    """
    cols = [F.lit(int(seed)), F.lit(salt), *[F.col(p) if isinstance(p, str) else p for p in parts]]
    h = F.xxhash64(*cols)
    # keep 53 bits -> exact double in [0, 1)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(2**53))


def key_uniform(seed: int, salt: str) -> Column:
    """Uniform in [0, 1) of a canonical row's key: 13 hexadecimal digits of an MD5, which any engine can repeat."""
    key = F.concat_ws("|", F.lit(f"{seed}|{salt}"), F.col("series_id"), F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"), F.col("seq"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def key_normal(seed: int, salt: str) -> Column:
    """Standard normal by Box-Muller on two key uniforms."""
    u1 = F.greatest(key_uniform(seed, salt + "#u1"), F.lit(1e-300))
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * key_uniform(seed, salt + "#u2"))
