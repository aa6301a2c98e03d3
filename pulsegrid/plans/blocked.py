"""Plain and blocked execution of per-series window work.

Plain plan: ``Window.partitionBy(series_id).orderBy(ts, seq)``; one Exchange and
one Sort shared by every window column of an operator. A series is one task.

Blocked plan (for very long series; one series may hold a third of all rows):

1. ordinal: the rows are written once in sampled ranges of ``(series_id, ts, seq)``
   with about half a block of rows each (small blocks: many to a range, so that the ranges
   do not grow in number as the blocks get smaller); range row counts (a small table) are
   prefix-summed into offsets; ``row_number`` inside ``(series_id, range)`` plus the
   offset is the exact global position ``_ord``.
2. ``_blk = floor(_ord / B)``; rows in the last ``lookback`` positions of a block
   are copied into the next block, rows in the first ``lookahead`` positions into
   the previous one (halo). Windows run over ``(series_id, _blk)`` and only the
   home copies are kept. Any frame bounded by ``lookback``/``lookahead`` rows is
   exact.
3. Unbounded fills use block summaries instead of halos (``carry_fill``).

``choose_plan('auto')`` looks at the series' lengths once (one small aggregate, kept for
the same plan over files of the same size) and takes the blocked plan where a series is longer than
``hot_rows``. Windows, ordinals and fills then take only the long series through blocks (``split_hot``);
the others stay on the plain plan, however many rows they hold together. Both plans give the same rows.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.frame import KEY, ORDER, series_window
from pulsegrid.plans.lineage import materialize

HOT_ROWS = 5_000_000
BLOCK_ROWS = 1_000_000
#: Ranges that small blocks may take at most, while a range holds no more than half of ``BLOCK_ROWS``.
RANGES = 64

_local = threading.local()


def default_block_rows() -> int:
    """Block size for plans built now: a per-thread override (``forced_blocks``) or ``BLOCK_ROWS``."""
    return getattr(_local, "block_rows", None) or BLOCK_ROWS

#: Decisions of the last plans: the plan itself (equal hashes are checked), the choice, whether series of both sizes are there.
_plan_cache: dict[tuple, tuple[DataFrame, str, bool]] = {}
PLANS_KEPT = 64

Builder = Callable[[DataFrame, Sequence[str]], DataFrame]


def epoch_micros(name: str = "ts") -> Column:
    """Microseconds since 1970 for a TIMESTAMP_NTZ column (no session time zone)."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")


def choose_plan(df: DataFrame, plan: str = "auto", hot_rows: int | None = None) -> str:
    """'plain' | 'blocked'; 'auto' checks the row count of the largest series."""
    return _decide(df, plan, hot_rows)[0]


def _decide(df: DataFrame, plan: str, hot_rows: int | None = None) -> tuple[str, bool]:
    """The plan, and whether 'auto' found series of both sizes."""
    hot_rows = hot_rows or HOT_ROWS
    if plan in ("plain", "blocked"):
        return plan, False
    if plan != "auto":
        raise ValueError(f"unknown plan: {plan}")
    # the size of the files as the plan knows them stands for their state; their names stay in the JVM
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    key = (df.semanticHash(), hot_rows, size)
    known = _plan_cache.get(key)
    if known is not None and known[0].sameSemantics(df):
        return known[1:]
    row = _lengths(df).agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    hot = (row["most"] or 0) > hot_rows
    decided = ("blocked", row["least"] <= hot_rows) if hot else ("plain", False)
    _plan_cache[key] = (df, *decided)
    while len(_plan_cache) > PLANS_KEPT:
        _plan_cache.pop(next(iter(_plan_cache)))
    return decided


def _lengths(df: DataFrame) -> DataFrame:
    return df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))


def split_hot(df: DataFrame, plan: str = "auto", hot_rows: int | None = None) -> list[tuple[DataFrame, str]]:
    """``df`` as parts with the plan of each: with 'auto' only series above ``hot_rows`` are blocked.

    The names of the long series (at most the rows of ``df`` / ``hot_rows``) are written once; Spark
    broadcasts them where their size allows it. A null series is a series like any other."""
    chosen, both = _decide(df, plan, hot_rows)
    if not both:
        return [(df, chosen)]
    hot = _lengths(df).where(F.col("n") > (hot_rows or HOT_ROWS)).select(F.col(KEY).alias("_hot"))
    hot = materialize(hot, "hot_series")
    is_hot = df[KEY].eqNullSafe(hot["_hot"])
    return [(df.join(hot, is_hot, "left_anti"), "plain"), (df.join(hot, is_hot, "left_semi"), "blocked")]


def _by_parts(df: DataFrame, plan: str, run: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``run(part, its plan)`` over the parts of ``split_hot``, put together."""
    return reduce(DataFrame.unionByName, (run(part, how) for part, how in split_hot(df, plan)))


def join_null_safe(x: DataFrame, y: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``x.join(y, on, how)`` in which a null series meets itself."""
    names = {c: f"__on_{i}" for i, c in enumerate(on)}
    y = y.select(*[F.col(c).alias(names.get(c, c)) for c in y.columns])
    return x.join(y, reduce(and_, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items())), how).drop(*names.values())


def _bucketed(df: DataFrame, block_rows: int, order: Sequence[Column | str]) -> DataFrame:
    """Adds ``__tb``: ascending ranges of ``(series, *order)`` with about half of ``block_rows`` rows each, or more
    where that would be over ``RANGES`` ranges of less than half of ``BLOCK_ROWS``: every range is a task and a file,
    and its sampled rows go to the driver.

    The range boundaries are sampled from the rows themselves, so bursts and equal
    timestamps are split too (only rows equal in the whole order stay together). The rows
    are written once in their ranges: counts, ranks and later readers see the same ranges.
    """
    halves = 2 * df.count()
    ranges = max(1, min(-(-halves // block_rows), max(RANGES, -(-halves // BLOCK_ROWS))))
    return materialize(df.repartitionByRange(ranges, KEY, *order).withColumn("__tb", F.spark_partition_id().cast("long")), "blocks")


def blocked_ordinal(
    df: DataFrame,
    block_rows: int | None = None,
    name: str = "_ord",
    order: Sequence[Column | str] = ORDER,
) -> DataFrame:
    """Exact 0-based rank inside the series by ``order`` without a per-series
    sort in one task: range counts are prefix-summed over the small range table
    and added to the rank inside each range."""
    block_rows = block_rows or default_block_rows()
    x = _bucketed(df, block_rows, order)
    counts = x.groupBy(KEY, "__tb").agg(F.count(F.lit(1)).alias("__bc"))
    wb = Window.partitionBy(KEY).orderBy("__tb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(KEY, "__tb", F.coalesce(F.sum("__bc").over(wb), F.lit(0)).alias("__off"))
    x = join_null_safe(x, offsets, [KEY, "__tb"])
    rn = F.row_number().over(Window.partitionBy(KEY, "__tb").orderBy(*order))
    return x.withColumn(name, (rn - 1 + F.col("__off")).cast("long")).drop("__tb", "__off")


def rank_within(df: DataFrame, name: str, order: Sequence[Column | str], plan: str = "auto", block_rows: int | None = None) -> DataFrame:
    """0-based rank inside each series by ``order``."""

    def run(part: DataFrame, how: str) -> DataFrame:
        if how == "blocked":
            return blocked_ordinal(part, block_rows, name, order)
        return part.withColumn(name, (F.row_number().over(Window.partitionBy(KEY).orderBy(*order)) - 1).cast("long"))

    return _by_parts(df, plan, run)


def with_ordinal(df: DataFrame, name: str = "ord", plan: str = "auto", block_rows: int | None = None) -> DataFrame:
    """PRJ-04: 0-based position of each row inside its series in ``(ts, seq)`` order."""
    return rank_within(df, name, ORDER, plan, block_rows)


def apply_windows(
    df: DataFrame,
    build: Builder,
    lookback: int,
    lookahead: int = 0,
    plan: str = "auto",
    block_rows: int | None = None,
) -> DataFrame:
    """Run ``build(df, extra_partition_cols)`` under the chosen plan.

    ``build`` must only use frames reaching at most ``lookback`` rows back and
    ``lookahead`` rows forward, with ``series_window(*extra)`` as the window.
    """
    block_rows = block_rows or default_block_rows()

    def run(part: DataFrame, how: str) -> DataFrame:
        return build(part, []) if how == "plain" else _halo_windows(part, build, lookback, lookahead, block_rows)

    return _by_parts(df, plan, run)


def _halo_windows(df: DataFrame, build: Builder, lookback: int, lookahead: int, block_rows: int) -> DataFrame:
    if block_rows < max(lookback, lookahead):
        raise ValueError("block_rows must be at least the frame reach")
    x = blocked_ordinal(df, block_rows, "_ord")
    blk = F.floor(F.col("_ord") / block_rows).cast("long")
    pos = F.col("_ord") - blk * block_rows
    copies = F.array_compact(
        F.array(
            F.struct(blk.alias("b"), F.lit(True).alias("home")),
            F.when(pos >= block_rows - lookback, F.struct((blk + 1).alias("b"), F.lit(False).alias("home"))),
            F.when((pos < lookahead) & (blk > 0), F.struct((blk - 1).alias("b"), F.lit(False).alias("home"))),
        )
    )
    x = x.withColumn("_cp", F.explode(copies)).withColumn("_blk", F.col("_cp.b")).withColumn(
        "_home", F.col("_cp.home")
    ).drop("_cp")
    out = build(x, ["_blk"])
    return out.filter(F.col("_home")).drop("_blk", "_home", "_ord")


def carry_fill(df: DataFrame, col: str = "value", plan: str = "auto", block_rows: int | None = None) -> DataFrame:
    """Adds ``_prev_v/_prev_o/_prev_t`` and ``_next_v/_next_o/_next_t``: the nearest
    non-null value, its ordinal and its epoch microseconds, before-or-at and
    at-or-after each row; also ``ord``.

    The plain plan uses unbounded frames over the series; the blocked plan fills
    inside blocks and takes the carry-in from a small per-block summary table.
    """
    block_rows = block_rows or default_block_rows()

    def run(part: DataFrame, how: str) -> DataFrame:
        if how == "plain":
            return _fill_cols(with_ordinal(part, "ord", "plain"), series_window(), F.col(col))
        return _fill_blocks(part, F.col(col), block_rows)

    return _by_parts(df, plan, run)


def _fill_blocks(df: DataFrame, v: Column, block_rows: int) -> DataFrame:
    x = blocked_ordinal(df, block_rows, "ord")
    # read by the summary, the block list and the fill: written once
    x = materialize(x.withColumn("_blk", F.floor(F.col("ord") / block_rows).cast("long")), "blocks")
    rows = x
    x = _fill_cols(x, series_window("_blk"), v)
    nn = rows.filter(v.isNotNull())
    summary = nn.groupBy(KEY, "_blk").agg(
        F.max_by(F.struct(v.alias("v"), F.col("ord").alias("o"), epoch_micros("ts").alias("t")), F.col("ord")).alias(
            "_last"
        ),
        F.min_by(F.struct(v.alias("v"), F.col("ord").alias("o"), epoch_micros("ts").alias("t")), F.col("ord")).alias(
            "_first"
        ),
    )
    wb = Window.partitionBy(KEY).orderBy("_blk")
    # every block without a non-null value still needs carries: take them from the block list
    blocks = rows.select(KEY, "_blk").distinct()
    allb = join_null_safe(blocks, summary, [KEY, "_blk"], "left")
    carry = allb.select(
        KEY,
        "_blk",
        F.last("_last", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_cin"),
        F.first("_first", ignorenulls=True).over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("_cout"),
    )
    x = join_null_safe(x, carry, [KEY, "_blk"], "left")
    x = (
        x.withColumn("_prev_v", F.coalesce(F.col("_prev_v"), F.col("_cin.v")))
        .withColumn("_prev_o", F.coalesce(F.col("_prev_o"), F.col("_cin.o")))
        .withColumn("_next_v", F.coalesce(F.col("_next_v"), F.col("_cout.v")))
        .withColumn("_next_o", F.coalesce(F.col("_next_o"), F.col("_cout.o")))
        .withColumn("_prev_t", F.coalesce(F.col("_prev_t"), F.col("_cin.t")))
        .withColumn("_next_t", F.coalesce(F.col("_next_t"), F.col("_cout.t")))
    )
    return x.drop("_cin", "_cout", "_blk")


def _fill_cols(x: DataFrame, w: Window, v: Column) -> DataFrame:
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    fwd = w.rowsBetween(0, Window.unboundedFollowing)
    o = F.when(v.isNotNull(), F.col("ord"))
    t = F.when(v.isNotNull(), epoch_micros("ts"))
    return x.select(
        "*",
        F.last(v, ignorenulls=True).over(back).alias("_prev_v"),
        F.last(o, ignorenulls=True).over(back).alias("_prev_o"),
        F.last(t, ignorenulls=True).over(back).alias("_prev_t"),
        F.first(v, ignorenulls=True).over(fwd).alias("_next_v"),
        F.first(o, ignorenulls=True).over(fwd).alias("_next_o"),
        F.first(t, ignorenulls=True).over(fwd).alias("_next_t"),
    )


@contextmanager
def forced_blocks(block_rows: int, sort_rows: int | None = None) -> Iterator[None]:
    """Build plans with a given block size (and exact-quantile sort limit).

    Sizes are read when an operator builds its plan, so wrapping the construction
    is enough. The override is per thread, so concurrent queries are unaffected.
    Used to run the blocked plan on small inputs (tests, checks).
    """
    old_b, old_s = getattr(_local, "block_rows", None), getattr(_local, "sort_rows", None)
    _local.block_rows = block_rows
    if sort_rows is not None:
        _local.sort_rows = sort_rows
    try:
        yield
    finally:
        _local.block_rows, _local.sort_rows = old_b, old_s


def default_sort_rows(fallback: int) -> int:
    return getattr(_local, "sort_rows", None) or fallback
