"""ANO-02/03 with one detector over all data: a shared isolation forest, broadcast to score rows in place.

The sample is panel-wide: a row passes a tree if its hash for that tree is below one global limit, which leaves each tree
somewhat more than ``psi`` rows, and the tree keeps its ``psi`` smallest hashes; no shuffle but of the sampled rows.
All trees grow in one task on at most about ``trees * 350`` rows. The model is one row of node arrays, bounded by
``trees * (2 psi - 1)`` nodes whatever the data's size; its size is checked before it is broadcast. A scalar Arrow function adds the score to any
row with the features, of series that were in the fit or not: the scoring plan has no exchange.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER
from pulsegrid.operators.anomaly import _check, _depth_limit, _samples, grow_forest, walk
from pulsegrid.operators.quantiles import quantiles
from pulsegrid.plans.lineage import materialize
from pulsegrid.session import ship_package

FOREST = "n_trees int, psi int, n long, features array<string>, feature array<tinyint>, split array<double>, left array<int>, size array<int>, tree array<smallint>"
#: Nodes that are broadcast at most: some 40 MB of arrays.
MAX_NODES = 2_000_000


def _complete(cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return ok


def sample_rows(features: DataFrame, cols: Sequence[str], n: int, n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """(series_id, ts, seq, features.., picks): the rows that some tree may keep, out of ``n`` complete rows."""
    limit = min(1.0, (max_samples + 6.0 * math.sqrt(max_samples)) / max(n, 1))
    row = F.xxhash64(F.lit(int(seed)), F.lit("shared-forest"), KEY, *ORDER, *cols)
    draws = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(t.alias("tree"), (F.shiftrightunsigned(F.xxhash64(row, t), 11).cast("double") / F.lit(float(2**53))).alias("u")))
    return features.select(KEY, *ORDER, *cols, F.filter(draws, lambda d: d["u"] < limit).alias("picks")).where(F.size("picks") > 0)


def fit(features: DataFrame, cols: Sequence[str], n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """One forest over the complete rows of all series: a table of one row (none if no row is complete)."""
    cols = list(cols)
    _check(cols, n_trees)
    usable = features.where(_complete(cols))
    n = usable.count()
    # rows that are equal in key and features share their hashes: they count as one in a sample
    sampled = sample_rows(usable, cols, n, n_trees, max_samples, seed).dropDuplicates([KEY, *ORDER, *cols])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([KEY, *ORDER, *cols], kind="stable").reset_index(drop=True)
        row, t = _samples(pdf, n_trees, max_samples)
        psi = int(np.bincount(t, minlength=n_trees).max())
        rng = np.random.default_rng([seed, zlib.crc32(b"shared")])
        tree, feature, split, left, _, size = grow_forest(pdf[cols].to_numpy(float)[row], t, n_trees, _depth_limit(psi), rng)
        return pd.DataFrame({"n_trees": [n_trees], "psi": [psi], "n": [n], "features": [cols], "feature": [feature.astype(np.int8)], "split": [split.astype(float)], "left": [left.astype(np.int32)], "size": [size.astype(np.int32)], "tree": [tree.astype(np.int16)]})

    # a bounded sample: one group
    return materialize(sampled.groupBy().applyInPandas(grow, FOREST), "shared_forest")


def score(features: DataFrame, forest: DataFrame) -> DataFrame:
    """``features`` with ``score`` in (0, 1) under the shared forest; NULL for rows with a missing feature."""
    model = forest.first()
    if model is None:
        return features.withColumn("score", F.lit(None).cast("double"))
    if len(model["feature"]) > MAX_NODES:
        raise ValueError(f"a forest of more than {MAX_NODES} nodes is not broadcast")
    spark = features.sparkSession
    ship_package(spark)
    arrays = spark.sparkContext.broadcast(
        (np.asarray(model["feature"], np.int64), np.asarray(model["split"], float), np.asarray(model["left"], np.int64), np.asarray(model["size"]), int(model["n_trees"]), int(model["psi"]))
    )

    @F.pandas_udf("double")
    def scored(*columns: pd.Series) -> pd.Series:
        X = np.column_stack([c.to_numpy(float, na_value=np.nan) for c in columns])
        whole = ~np.isnan(X).any(axis=1)
        out = np.full(len(X), np.nan)
        if whole.any():
            out[whole] = walk(X[whole], *arrays.value)
        return pd.Series(out).astype(object).where(whole, None).astype("Float64")

    return features.withColumn("score", scored(*[F.col(c).cast("double") for c in model["features"]]))


def threshold(scores: DataFrame, contamination: float = 0.1, plan: str = "auto") -> float | None:
    """The ``1 - contamination`` quantile of all scores, exact and distributed."""
    if not 0 < contamination < 0.5:
        raise ValueError("contamination must be in (0, 0.5)")
    found = quantiles(scores.select(F.lit("all").alias(KEY), *ORDER, "score").where("score is not null"), [1.0 - contamination], "score", plan).first()
    return None if found is None else found["q"][0]


def flag(scores: DataFrame, cut: float | None) -> DataFrame:
    """Adds ``anomaly``: score above the cut; NULL where nothing was scored."""
    return scores.withColumn("anomaly", F.col("score") > F.lit(cut).cast("double"))
