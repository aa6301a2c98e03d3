"""Deterministic baseline forecasts (last value, train mean, seasonal naive).

They are our fixtures for MET-01 and ENS-02/03: fully SQL-expressible, so the
metric and ensemble operators get an exact oracle. Model forecasts (FC-*) feed
the same operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY
from pulsegrid.operators.columns import train_test_split
from pulsegrid.operators.stats import attach
from pulsegrid.sources.spine import count_out


def split_parts(df: DataFrame, train_fraction: float = 0.8, plan: str = "auto") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (train rows with ord, test actuals with step, per-series sizes)."""
    x = train_test_split(df, train_fraction, plan)
    sizes = x.groupBy(KEY).agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test")
    )
    train = x.filter(F.col("split") == "train")
    test = attach(x.filter(F.col("split") == "test"), sizes).select(
        KEY, "ts", (F.col("ord") - F.col("n_train") + 1).cast("int").alias("step"), F.col("value").alias("actual")
    )
    return train, test, sizes


def baseline_forecasts(train: DataFrame, sizes: DataFrame, season: int = 24) -> DataFrame:
    """``(series_id, model, step, forecast)`` for steps 1..n_test of each series."""
    agg = train.groupBy(KEY).agg(
        F.max_by(F.col("value"), F.when(F.col("value").isNotNull(), F.col("ord"))).alias("last"),
        F.avg("value").alias("mean"),
    )
    steps = count_out(sizes.filter(F.col("n_test") > 0).select(KEY, "n_train", "n_test"), "n_test", "step").select(KEY, "n_train", F.col("step").cast("int").alias("step"))
    x = attach(steps, agg)
    seasonal_ord = F.col("n_train") - season + ((F.col("step") - 1) % season)
    season_vals = train.select(KEY, F.col("ord").alias("_so"), F.col("value").alias("snaive"))
    x = x.withColumn("_so", seasonal_ord.cast("long")).join(season_vals, [KEY, "_so"], "left")
    models = F.array(
        F.struct(F.lit("naive").alias("model"), F.col("last").alias("forecast")),
        F.struct(F.lit("mean").alias("model"), F.col("mean").alias("forecast")),
        F.struct(F.lit("snaive").alias("model"), F.col("snaive").alias("forecast")),
    )
    return x.select(KEY, "step", F.explode(models).alias("m")).select(KEY, "m.model", "step", "m.forecast")


def ensemble(forecasts: DataFrame, method: str = "average") -> DataFrame:
    """ENS-02/03: combine member forecasts per (series, step); failed members
    (NULL forecast or status <> 'ok') are skipped, NULL when none is left."""
    f = forecasts
    v = F.when(F.col("status") == "ok", F.col("forecast")) if "status" in f.columns else F.col("forecast")
    if method == "average":
        agg = F.avg(v)
    elif method == "median":
        agg = F.percentile(v, 0.5)
    else:
        raise ValueError(f"Unknown ensemble method: {method}")
    return f.groupBy(KEY, "step").agg(agg.alias("forecast"), F.count(v).alias("n_members"))
