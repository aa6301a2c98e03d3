"""Exact per-series quantiles that stay exact and distributed for a huge series.

``percentile`` (plain plan) merges one value->count map per group in a single
task, which does not survive a series holding a third of all rows. The blocked
plan finds every needed order statistic by narrowing a value range level by
level: approximate cut points (``percentile_approx``) split the candidates of a
rank into ``fanout`` buckets, bucket counts (a small table) locate the bucket
holding the rank, and only that bucket's rows stay candidates. When at most
``max_sort_rows`` candidates are left (or they are all equal), a bounded sort
picks the exact value. Interpolation between the two neighbouring order
statistics is the same formula as Spark's ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.frame import KEY
from pulsegrid.plans.blocked import choose_plan, default_sort_rows
from pulsegrid.plans.lineage import materialize


MAX_SORT_ROWS = 2_000_000


def quantiles(
    df: DataFrame,
    probs: Sequence[float],
    col: str = "value",
    plan: str = "auto",
    max_sort_rows: int | None = None,
    fanout: int = 64,
    max_levels: int = 40,
) -> DataFrame:
    """``(series_id, q ARRAY<DOUBLE>)``: exact quantiles (linear interpolation), NULLs skipped."""
    max_sort_rows = max_sort_rows or default_sort_rows(MAX_SORT_ROWS)
    x = df.select(KEY, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if choose_plan(df, plan) == "plain":
        # grouped over all rows: a series with only NULLs keeps a row with NULL quantiles
        v = F.col(col).cast("double")
        return df.groupBy(KEY).agg(F.percentile(v, F.array(*[F.lit(float(p)) for p in probs])).alias("q"))

    n = x.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    ents = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        ents.append(F.struct(F.lit(i).alias("qi"), pos.alias("pos"), F.floor(pos).cast("long").alias("lo"), F.ceil(pos).cast("long").alias("hi")))
    targets = materialize(n.select(KEY, F.explode(F.array(*ents)).alias("t")).select(KEY, "t.*"), "quantile_targets")
    ranks = targets.select(KEY, F.col("lo").alias("k")).unionByName(targets.select(KEY, F.col("hi").alias("k"))).distinct()

    # state per (series, k): the k-th value lies in (a, b]; `below` values are <= a
    state = ranks.select(KEY, "k", F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"), F.lit(0).cast("long").alias("below"))
    solved = []
    probs_cuts = [j / fanout for j in range(1, fanout)]
    finished = False
    for _ in range(max_levels):
        cond = (F.col("a").isNull() | (F.col("_v") > F.col("a"))) & (F.col("b").isNull() | (F.col("_v") <= F.col("b")))
        cand = x.join(state, KEY).filter(cond).select(KEY, "k", "a", "b", "below", "_v")
        summary = cand.groupBy(KEY, "k").agg(
            F.count(F.lit(1)).alias("c"),
            F.min("_v").alias("mn"),
            F.max("_v").alias("mx"),
            F.first("below").alias("below"),
            F.first("a").alias("a"),
            F.first("b").alias("b"),
        )
        summary = materialize(summary, "quantile_level")
        done_equal = summary.filter(F.col("mn") == F.col("mx")).select(KEY, "k", F.col("mn").alias("val"))
        small = summary.filter((F.col("mn") != F.col("mx")) & (F.col("c") <= max_sort_rows)).select(KEY, "k")
        rn = F.row_number().over(Window.partitionBy(KEY, "k").orderBy("_v"))
        picked = (
            cand.join(small, [KEY, "k"])
            .withColumn("_r", rn - 1 + F.col("below"))
            .filter(F.col("_r") == F.col("k"))
            .select(KEY, "k", F.col("_v").alias("val"))
        )
        solved += [done_equal, picked]
        big = summary.filter((F.col("mn") != F.col("mx")) & (F.col("c") > max_sort_rows)).select(KEY, "k", "a", "b", "below")
        if big.limit(1).count() == 0:
            finished = True
            break
        # refine the large ones: approximate cuts, bucket counts, locate the rank's bucket
        cb = cand.join(big.select(KEY, "k"), [KEY, "k"])
        cuts = cb.groupBy(KEY, "k").agg(F.percentile_approx("_v", probs_cuts, 10000).alias("cuts"))
        cuts = materialize(cuts, "quantile_cuts")
        bucketed = cb.join(cuts, [KEY, "k"]).withColumn("_bk", F.size(F.filter("cuts", lambda c: c < F.col("_v"))))
        counts = bucketed.groupBy(KEY, "k", "_bk").agg(F.count(F.lit(1)).alias("_c"))
        wb = Window.partitionBy(KEY, "k").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(wb), F.lit(0)))
        loc = counts.join(big, [KEY, "k"]).filter(
            (F.col("below") + F.col("_before") <= F.col("k")) & (F.col("k") < F.col("below") + F.col("_before") + F.col("_c"))
        )
        loc = loc.join(cuts, [KEY, "k"])
        # the outer buckets keep the previous bounds of the range
        new_a = F.when(F.col("_bk") > 0, F.element_at("cuts", F.col("_bk").cast("int"))).otherwise(F.col("a"))
        new_b = F.when(F.col("_bk") < F.size("cuts"), F.element_at("cuts", (F.col("_bk") + 1).cast("int"))).otherwise(F.col("b"))
        state = materialize(
            loc.select(KEY, "k", new_a.alias("a"), new_b.alias("b"), (F.col("below") + F.col("_before")).alias("below")),
            "quantile_state",
        )
    if not finished:
        raise RuntimeError("quantile refinement did not converge; raise max_levels or max_sort_rows")
    vals = solved[0]
    for s in solved[1:]:
        vals = vals.unionByName(s)
    vals = materialize(vals, "quantile_values")
    lo = vals.select(KEY, F.col("k").alias("lo"), F.col("val").alias("v_lo"))
    hi = vals.select(KEY, F.col("k").alias("hi"), F.col("val").alias("v_hi"))
    t = targets.join(lo, [KEY, "lo"]).join(hi, [KEY, "hi"])
    interp = F.when(F.col("lo") == F.col("hi"), F.col("v_lo")).otherwise(
        (F.col("hi") - F.col("pos")) * F.col("v_lo") + (F.col("pos") - F.col("lo")) * F.col("v_hi")
    )
    arr = F.array_sort(F.collect_list(F.struct("qi", interp.alias("v"))))
    found = t.groupBy(KEY).agg(F.transform(arr, lambda e: e.v).alias("q"))
    # series without any non-NULL value keep a row with NULL quantiles, as in the plain plan
    return df.select(KEY).distinct().join(found, KEY, "left")
