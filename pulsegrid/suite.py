"""The registered query suite: Spark query + DuckDB oracle SQL per operator.

Every query reads the driver tables (through the panels) over whole tables.
Float columns are snapped to multiples of ``2**-bits`` on both sides (and -0.0
folded into 0.0) so that summation-order noise between two engines does not
decide the comparison. A binary grid is used because decimal input data lands
exactly on decimal rounding ties (e.g. x.xxxxxx5) far more often than on binary
ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import sqlparts as S
from pulsegrid.operators import clean, columns, decompose, rolling, setops, stats
from pulsegrid.sources import panels
from pulsegrid.plans.blocked import choose_plan
from pulsegrid.session import ensure_checkpoint_dir, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def finish(df: DataFrame, bits: int = 20) -> DataFrame:
    """Snap DOUBLE columns to the 2**-bits grid (and fold -0.0) like ``sqlparts.rounded``."""
    q = float(2**bits)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append((F.round(F.col(f.name) * q, 0) / q + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, doubles: list[str] | None = None, bits: int = 20):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return finish(fn(spark, sf_dir), bits)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = S.rounded(sql, doubles or [], bits)
        return run

    return deco


def p1(spark, d):
    return panels.user_series(spark, d)


def p1m(spark, d):
    return panels.masked(panels.user_series(spark, d))


def p2(spark, d):
    return panels.hourly_by_type(spark, d)


def p3(spark, d):
    return panels.daily_orders(spark, d)


def p4(spark, d):
    return panels.single_series(spark, d)


# ---------------------------------------------------------------- flagship
def flagship(spark: SparkSession, sf_dir: str, window: int = 10) -> DataFrame:
    """P2 -> IQR outliers masked -> linear interpolation -> z-score -> rolling stats.

    The plain/blocked decision is taken once on the input panel (series lengths
    do not change along the chain) and passed to every window operator."""
    src = p2(spark, sf_dir)
    plan = choose_plan(src)
    x = clean.remove_outliers(src, "iqr")
    x = clean.interpolate(x, "linear", plan=plan)
    x = clean.normalize(x, "zscore")
    return rolling.rolling_stats(x, window, plan=plan)


_FLAG_SQL = S.rolling_stats(S.normalize(S.interpolate(S.remove_outliers(S.P2, "iqr"), "linear"), "zscore"), 10)


@register("preprocess_rolling", _FLAG_SQL, S.ROLLING_DOUBLES)
def q_preprocess_rolling(spark, d):
    """Flagship chain over every hourly event-type series."""
    return flagship(spark, d)


# ---------------------------------------------------------------- windows
@register("rolling_stats", S.rolling_stats(S.P1M, 30), S.ROLLING_DOUBLES)
def q_rolling_stats(spark, d):
    """WIN-01 (N=30, partial warm-up) on the per-user panel with missing values."""
    return rolling.rolling_stats(p1m(spark, d), 30)


@register("rolling_stats_full", S.rolling_stats(S.P1, 10, "full"), S.ROLLING_DOUBLES)
def q_rolling_stats_full(spark, d):
    """WIN-01 with full-window warm-up (N=10)."""
    return rolling.rolling_stats(p1(spark, d), 10, warmup="full")


@register("rolling_stats_long", S.rolling_stats(S.P4, 30), S.ROLLING_DOUBLES)
def q_rolling_stats_long(spark, d):
    """WIN-01 over all events as one long series."""
    return rolling.rolling_stats(p4(spark, d), 30)


@register(
    "rolling_mean_zero_pad",
    f"SELECT series_id, ts, seq, value, coalesce(sum(value) OVER ({S.W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0.0) / 30.0 AS mean_zero_pad FROM ({S.P1M}) _z",
    ["value", "mean_zero_pad"],
)
def q_rolling_mean_zero_pad(spark, d):
    """WIN-02: zero-padded rolling mean (N=30)."""
    return rolling.rolling_mean_zero_pad(p1m(spark, d), 30)


def _rolling_full_sql(src):
    cols = []
    for n in (5, 10, 20):
        m, s = S.full_mean_std(n)
        cols += [f"{m} AS mean{n}", f"{s} AS std{n}"]
    return f"SELECT series_id, ts, seq, value, {', '.join(cols)} FROM ({src}) _r"


@register(
    "rolling_full",
    _rolling_full_sql(S.P1M),
    ["value", "mean5", "std5", "mean10", "std10", "mean20", "std20"],
)
def q_rolling_full(spark, d):
    """WIN-03: complete-window mean/std for N in 5, 10, 20, NULLs inside."""
    return rolling.rolling_full(p1m(spark, d))


@register(
    "lags",
    f"SELECT series_id, ts, seq, value, lag(value, 1) OVER ({S.W}) AS lag1, lag(value, 2) OVER ({S.W}) AS lag2, lag(value, 3) OVER ({S.W}) AS lag3 FROM ({S.P1}) _l",
    ["value", "lag1", "lag2", "lag3"],
)
def q_lags(spark, d):
    """WIN-04: lags 1..3."""
    return rolling.lags(p1(spark, d))


def _band_sql(src, n=50):
    w = f"({S.W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    s1 = f"SELECT series_id, ts, seq, value, avg(value) OVER {w} AS mean, min(value) OVER {w} AS vmin, max(value) OVER {w} AS vmax FROM ({src}) _a"
    s2 = f"SELECT series_id, ts, seq, value, mean, least(vmin, min(mean) OVER {w}) AS lo, greatest(vmax, max(mean) OVER {w}) AS hi FROM ({s1}) _b"
    return f"SELECT series_id, ts, seq, value, mean, lo - (hi - lo) * 0.1 AS band_lo, hi + (hi - lo) * 0.1 AS band_hi FROM ({s2}) _c"


@register("rolling_band", _band_sql(S.P1), ["value", "mean", "band_lo", "band_hi"])
def q_rolling_band(spark, d):
    """WIN-05: live-view mean and padded band (N=50)."""
    return rolling.rolling_band(p1(spark, d), 50)


def _cma_sql(src, m):
    h = m // 2
    fr = f"({S.W} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    tot = f"sum(value) OVER {fr}"
    if m % 2 == 0:
        tot = f"({tot} - 0.5 * (lag(value, {h}) OVER ({S.W}) + lead(value, {h}) OVER ({S.W})))"
    ok = f"count(*) OVER {fr} = {2 * h + 1} AND count(value) OVER {fr} = {2 * h + 1}"
    return f"SELECT series_id, ts, seq, value, CASE WHEN {ok} THEN {tot} / {float(m)} END AS trend FROM ({src}) _m"


@register("centered_ma", _cma_sql(S.P2, 24), ["value", "trend"])
def q_centered_ma(spark, d):
    """WIN-06: 2x24 centred moving average on the hourly panel."""
    return rolling.centered_ma(p2(spark, d), 24)


@register("centered_ma_odd", _cma_sql(S.P1, 7), ["value", "trend"])
def q_centered_ma_odd(spark, d):
    """WIN-06 with an odd length (7)."""
    return rolling.centered_ma(p1(spark, d), 7)


@register(
    "current_stats",
    f"SELECT series_id, arg_max(ts, ts) AS ts, arg_max(seq, (ts, seq)) AS seq, arg_max(mean, (ts, seq)) AS mean, arg_max(std, (ts, seq)) AS std, arg_max(min, (ts, seq)) AS min, arg_max(max, (ts, seq)) AS max, arg_max(median, (ts, seq)) AS median, arg_max(current, (ts, seq)) AS current, arg_max(window_size, (ts, seq)) AS window_size FROM ({S.rolling_stats(S.P1, 30)}) _s GROUP BY series_id",
    S.ROLLING_DOUBLES,
)
def q_current_stats(spark, d):
    """WIN-07: latest rolling snapshot per series."""
    return rolling.current_stats(p1(spark, d), 30)


@register("anomaly_features", S.features(S.P1), S.FEATURES)
def q_anomaly_features(spark, d):
    """ANO-01: the nine detector features, incomplete rows dropped."""
    return rolling.anomaly_features(p1(spark, d))


@register("anomaly_features_masked", S.features(S.P1M), S.FEATURES)
def q_anomaly_features_masked(spark, d):
    """ANO-01 with NULLs inside the series (windows touching them are dropped)."""
    return rolling.anomaly_features(p1m(spark, d))


# ---------------------------------------------------------------- cleaning
@register("outlier_iqr", f"SELECT series_id, ts, seq, value, outlier FROM ({S.iqr_flag(S.P1M)}) _o", ["value"])
def q_outlier_iqr(spark, d):
    """OUT-01: IQR flags (missing -> false)."""
    return clean.outlier_iqr(p1m(spark, d))


@register("outlier_zscore", f"SELECT series_id, ts, seq, value, outlier FROM ({S.zscore_flag(S.P1M, 2.0)}) _o", ["value"])
def q_outlier_zscore(spark, d):
    """OUT-02: z-score flags with threshold 2."""
    return clean.outlier_zscore(p1m(spark, d), 2.0)


@register("remove_outliers", S.remove_outliers(S.P2, "iqr"), ["value"])
def q_remove_outliers(spark, d):
    """OUT-03: IQR outliers masked to NULL on the hourly panel."""
    return clean.remove_outliers(p2(spark, d), "iqr")


@register("remove_outliers_zscore", S.remove_outliers(S.P1, "zscore"), ["value"])
def q_remove_outliers_zscore(spark, d):
    """OUT-03 with the z-score method (threshold 3)."""
    return clean.remove_outliers(p1(spark, d), "zscore")


@register(
    "mask_outliers",
    f"SELECT series_id, ts, seq, CASE WHEN NOT coalesce(outlier, false) THEN value END AS value, outlier FROM ({S.iqr_flag(S.P1, 1.0)}) _m",
    ["value"],
)
def q_mask_outliers(spark, d):
    """PRJ-03: mask flagged values (flags from IQR with factor 1.0), flags kept."""
    f = clean.outlier_iqr(p1(spark, d), 1.0)
    return clean.mask_flagged(f, "outlier")


for _m in ("linear", "time", "index", "ffill", "bfill", "nearest"):

    def _mk(method):
        @register(f"interp_{method}", S.interpolate(S.P1M, method), ["value"])
        def q(spark, d):
            return clean.interpolate(p1m(spark, d), method)

        q.__doc__ = f"IMP: {method} interpolation on the masked per-user panel."
        return q

    _mk(_m)


@register("interp_linear_hourly", S.interpolate(S.P2, "linear"), ["value"])
def q_interp_linear_hourly(spark, d):
    """IMP-01 on the hourly spine (natural gaps)."""
    return clean.interpolate(p2(spark, d), "linear")


for _m in ("zscore", "minmax", "robust"):

    def _mk2(method):
        @register(f"norm_{method}", S.normalize(S.P1M, method), ["value"])
        def q(spark, d):
            return clean.normalize(p1m(spark, d), method)

        q.__doc__ = f"NRM: {method} scaling per series."
        return q

    _mk2(_m)


# ---------------------------------------------------------------- sources / sinks
from pulsegrid.operators import baselines  # noqa: E402
from pulsegrid.session import shared_dir  # noqa: E402
from pulsegrid.sources import files  # noqa: E402


@register("src_parquet", S.P1, ["value"])
def q_src_parquet(spark, d):
    """SRC-02: canonical frame written once to the shared folder and read back with its schema."""
    path = shared_dir(spark, "datasets", "src_parquet", unique=True)
    files.write_frame(p1(spark, d), path, "parquet")
    return files.read_frame(spark, path, "parquet")


@register("src_dispatch", S.P1M, ["value"])
def q_src_dispatch(spark, d):
    """SRC-03 + SNK-03: save as JSON with a manifest, load by the manifest's format."""
    path = shared_dir(spark, "datasets", "src_dispatch", unique=True)
    files.save_dataset(p1m(spark, d), path, "events_by_user", {"panel": "P1", "masked": "true"}, fmt="json")
    data, _ = files.load_dataset(spark, path)
    return data


@register("snk_parquet_roundtrip", S.P2, ["value"])
def q_snk_parquet_roundtrip(spark, d):
    """SNK-02: parquet dataset save + load of the hourly panel."""
    path = shared_dir(spark, "datasets", "snk_parquet", unique=True)
    files.save_dataset(p2(spark, d), path, "hourly", fmt="parquet")
    data, _ = files.load_dataset(spark, path)
    return data


@register("snk_csv_roundtrip", S.P1, ["value"])
def q_snk_csv_roundtrip(spark, d):
    """SNK-01: CSV with header, partitioned by a bucket of the series (a bounded number of folders), read back with an explicit schema."""
    path = shared_dir(spark, "datasets", "snk_csv", unique=True)
    bucketed = p1(spark, d).withColumn("bucket", F.pmod(F.xxhash64("series_id"), F.lit(16)))
    files.write_frame(bucketed.repartition("bucket"), path, "csv", partition_by=["bucket"])
    return files.read_frame(spark, path, "csv").select("series_id", "ts", "seq", "value")


@register("snk_json_roundtrip", S.P1M, ["value"])
def q_snk_json_roundtrip(spark, d):
    """SNK-04: JSON result sink and read-back."""
    path = shared_dir(spark, "datasets", "snk_json", unique=True)
    files.write_frame(p1m(spark, d), path, "json")
    return files.read_frame(spark, path, "json")


@register(
    "src_csv",
    "SELECT 'orders' AS series_id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts, CAST(0 AS BIGINT) AS seq, sum(o_totalprice) AS value FROM orders GROUP BY 2",
    ["value"],
    bits=8,
)
def q_src_csv(spark, d):
    """SRC-01: the reference's CSV shape (timestamp index + one value column)."""
    path = shared_dir(spark, "datasets", "src_csv", unique=True)
    files.write_frame(p3(spark, d).select("ts", "value"), path, "csv")
    return files.read_series_csv(spark, path, "orders")


_SPINE_SQL = """
SELECT sp.series_id, sp.ts, CAST(0 AS BIGINT) AS seq, h.value FROM (
  SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM (
    SELECT CAST(user_id AS VARCHAR) AS series_id, min(date_trunc('hour', ts)) AS lo, max(date_trunc('hour', ts)) AS hi
    FROM events GROUP BY 1)) sp
LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, sum(value) AS value
           FROM events GROUP BY 1, 2) h ON sp.series_id = h.series_id AND sp.ts = h.ts"""


@register("time_spine", _SPINE_SQL, ["value"])
def q_time_spine(spark, d):
    """SRC-04: hourly grid per user with the hourly value sums left-joined (gap fill)."""
    from pulsegrid.sources.spine import fill_on_spine

    ev = panels.table(spark, d, "events").select("user_id", "ts", "value")
    hourly = ev.groupBy(
        F.col("user_id").cast("string").alias("series_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    ).agg(F.sum("value").alias("value"))
    return fill_on_spine(hourly.withColumn("seq", F.lit(0).cast("long")), "1 hour")


# ---------------------------------------------------------------- generators
_ORDN = S.with_n(S.with_ord(S.P2))


@register(
    "gen_trend",
    f"SELECT series_id, ts, seq, value, ord, CASE WHEN n > 1 THEN ord * 0.1 * n / (n - 1) ELSE 0.0 END AS trend FROM ({_ORDN}) _g",
    ["value", "trend"],
)
def q_gen_trend(spark, d):
    """GEN-01: linear ramp column on the hourly panel."""
    return columns.gen_trend(p2(spark, d), 0.1)


@register(
    "gen_seasonality",
    f"SELECT series_id, ts, seq, value, ord, 0.5 * sin(2 * pi() * ord / 24) + 0.3 * 0.5 * sin(2 * pi() * ord / 168) AS seasonal FROM ({S.with_ord(S.P2)}) _g",
    ["value", "seasonal"],
)
def q_gen_seasonality(spark, d):
    """GEN-02: two-harmonic seasonal column."""
    return columns.gen_seasonality(p2(spark, d), 0.5, 24)


@register(
    "gen_sine",
    f"SELECT series_id, ts, seq, ord, sin(CASE WHEN n > 1 THEN ord * (10.0 * pi()) / (n - 1) ELSE 0.0 END) AS sine FROM ({S.with_n(S.with_ord(S.P1))}) _g",
    ["sine"],
)
def q_gen_sine(spark, d):
    """GEN-06: evenly spaced phase over 10*pi along each series."""
    return columns.gen_sine(p1(spark, d))


def _u(salt: str) -> str:
    """``key_uniform(42, salt)`` of a canonical row."""
    return f"(('0x' || substr(md5('42|{salt}|' || series_id || '|' || epoch_us(ts) || '|' || seq), 1, 13))::BIGINT / 4503599627370496.0)"


@register("add_noise", f"SELECT series_id, ts, seq, value, 0.1 * sqrt(-2.0 * ln(greatest({_u('noise#u1')}, 1e-300))) * cos(2.0 * pi() * {_u('noise#u2')}) AS noise FROM ({S.P2}) _n", ["value", "noise"])
def q_add_noise(spark, d):
    """GEN-03: hash-seeded Gaussian noise column (partition-independent)."""
    return columns.add_noise(p2(spark, d), 0.1, 42)


_SPIKE_SQL = f"""
SELECT series_id, ts, seq, value, rk < k AS is_spike, CASE WHEN rk < k THEN CASE WHEN sg < 0.5 THEN -3.0 ELSE 3.0 END * 0.1 ELSE 0.0 END AS spike FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY u, ts, seq) - 1 AS rk, CAST(floor(count(*) OVER (PARTITION BY series_id) * 0.05) AS BIGINT) AS k
  FROM (SELECT *, {_u('spike-pick')} AS u, {_u('spike-sign')} AS sg FROM ({S.P1}) _a) _b) _c"""


@register("inject_spikes", _SPIKE_SQL, ["value", "spike"])
def q_inject_spikes(spark, d):
    """GEN-04: exactly floor(p*n) spikes of +/-3*level per series."""
    return columns.inject_spikes(p1(spark, d), 0.05, 0.1, 42)


@register("compose_components")
def q_compose_components(spark, d):
    """GEN-05: synthetic value = trend + season + noise + spike on the hourly grid."""
    return columns.compose_components(p2(spark, d))


# ---------------------------------------------------------------- projections / filters / limits
@register("drop_missing", f"SELECT * FROM ({S.P1M}) _d WHERE value IS NOT NULL", ["value"])
def q_drop_missing(spark, d):
    """PRJ-01."""
    return columns.drop_missing(p1m(spark, d))


def _diff_sql(src):
    return f"SELECT series_id, ts, seq, value - lag(value) OVER ({S.W}) AS value FROM ({src}) _a"


@register(
    "difference",
    f"SELECT * FROM ({_diff_sql(f'SELECT * FROM ({_diff_sql(S.P1M)}) _b WHERE value IS NOT NULL')}) _c WHERE value IS NOT NULL",
    ["value"],
)
def q_difference(spark, d):
    """PRJ-02: second difference with NULL rows dropped after each pass."""
    return columns.difference(p1m(spark, d), 2)


@register("row_ordinal", S.with_ord(S.P1), ["value"])
def q_row_ordinal(spark, d):
    """PRJ-04: 0-based position in (ts, seq) order."""
    return columns.row_ordinal(p1(spark, d))


@register("row_ordinal_long", S.with_ord(S.P4), ["value"])
def q_row_ordinal_long(spark, d):
    """PRJ-04 on one long series."""
    return columns.row_ordinal(p4(spark, d))


@register(
    "train_test_split",
    f"SELECT series_id, ts, seq, value, ord, CASE WHEN ord < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM ({_ORDN}) _s",
    ["value"],
)
def q_train_test_split(spark, d):
    """FLT-01: positional 80/20 split per series."""
    return columns.train_test_split(p2(spark, d), 0.8)


@register(
    "split_by_flag",
    f"SELECT series_id, ts, seq, value, CASE WHEN outlier THEN 'anomalous' ELSE 'normal' END AS part FROM ({S.iqr_flag(S.P1)}) _f",
    ["value"],
)
def q_split_by_flag(spark, d):
    """FLT-02: rows labelled normal/anomalous by a left join of IQR flags."""
    base = p1(spark, d)
    flags = clean.outlier_iqr(base).select("series_id", "ts", "seq", F.col("outlier").alias("anomaly"))
    return columns.split_by_flag(base, flags, "anomaly")


@register(
    "head_per_series",
    f"SELECT series_id, ts, seq, value FROM ({S.with_ord(S.P1)}) _h WHERE ord < 10",
    ["value"],
)
def q_head_per_series(spark, d):
    """LIM-01: first 10 rows of each series (top-k report)."""
    return columns.head_per_series(p1(spark, d), 10)


@register(
    "tail_per_series",
    f"SELECT series_id, ts, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC, seq DESC) AS rn FROM ({S.P1}) _a) _t WHERE rn <= 10",
    ["value"],
)
def q_tail_per_series(spark, d):
    """LIM-02: last 10 rows of each series."""
    return columns.tail_per_series(p1(spark, d), 10)


@register("head_global", f"SELECT * FROM ({S.P1}) _g ORDER BY series_id, ts, seq LIMIT 10", ["value"])
def q_head_global(spark, d):
    """LIM-01 (global preview): first 10 rows in key order."""
    return columns.head(p1(spark, d), 10)


# ---------------------------------------------------------------- joins / sets
_ALIGN_SQL = """
WITH ev AS (SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_type, value FROM events),
a AS (SELECT series_id, ts, CAST(count(*) AS DOUBLE) AS v FROM ev GROUP BY 1, 2),
b AS (SELECT series_id, ts, sum(value) AS v FROM ev WHERE event_type = 'click' GROUP BY 1, 2),
c AS (SELECT series_id, ts, max(value) AS v FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT coalesce(a.series_id, b.series_id, c.series_id) AS series_id, coalesce(a.ts, b.ts, c.ts) AS ts,
       a.v AS events, b.v AS clicks, c.v AS purchase_max
FROM a FULL OUTER JOIN b ON a.series_id = b.series_id AND a.ts = b.ts
FULL OUTER JOIN c ON coalesce(a.series_id, b.series_id) = c.series_id AND coalesce(a.ts, b.ts) = c.ts"""


@register("align_outer", _ALIGN_SQL, ["events", "clicks", "purchase_max"])
def q_align_outer(spark, d):
    """JOI-01: three hourly per-user series with different coverage, aligned by full outer semantics."""
    ev = panels.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("series_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
        "event_type",
        "value",
    )
    a = ev.groupBy("series_id", "ts").agg(F.count(F.lit(1)).cast("double").alias("value"))
    b = ev.filter(F.col("event_type") == "click").groupBy("series_id", "ts").agg(F.sum("value").alias("value"))
    c = ev.filter(F.col("event_type") == "purchase").groupBy("series_id", "ts").agg(F.max("value").alias("value"))
    return setops.align_outer({"events": a, "clicks": b, "purchase_max": c})


@register(
    "union_series",
    f"SELECT *, 'hourly' AS source FROM ({S.P2}) _a UNION ALL SELECT *, 'daily_orders' AS source FROM ({S.P3}) _b",
    ["value"],
    bits=8,
)
def q_union_series(spark, d):
    """SET-01: hourly event-type series and the daily revenue series in one long table."""
    return setops.union_series({"hourly": p2(spark, d), "daily_orders": p3(spark, d)})


# ---------------------------------------------------------------- aggregates
@register(
    "summary_stats",
    f"SELECT series_id, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, CASE WHEN count(value) >= 3 THEN skewness(value) END AS skew, CASE WHEN count(value) >= 4 THEN kurtosis(value) END AS kurtosis FROM ({S.P1M}) _s GROUP BY series_id",
    ["mean", "std", "min", "max", "skew", "kurtosis"],
)
def q_summary_stats(spark, d):
    """AGG-01: count, mean, sample std, min, max, adjusted skew/kurtosis per user."""
    return stats.summary_stats(p1m(spark, d))


@register(
    "summary_stats_hourly",
    f"SELECT series_id, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, CASE WHEN count(value) >= 3 THEN skewness(value) END AS skew, CASE WHEN count(value) >= 4 THEN kurtosis(value) END AS kurtosis FROM ({S.P2}) _s GROUP BY series_id",
    ["mean", "std", "min", "max", "skew", "kurtosis"],
)
def q_summary_stats_hourly(spark, d):
    """AGG-01 on the hourly panel (gaps are NULL and skipped)."""
    return stats.summary_stats(p2(spark, d))


@register(
    "iqr_bounds",
    f"SELECT series_id, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT series_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ({S.P1}) _a GROUP BY 1) _b",
    ["q1", "q3", "iqr", "lower", "upper"],
)
def q_iqr_bounds(spark, d):
    """AGG-02: quartiles and fences."""
    return stats.iqr_bounds(p1(spark, d))


@register("median_mad", S.median_mad(S.P1M), ["median", "mad"])
def q_median_mad(spark, d):
    """AGG-03: median and unscaled MAD per series."""
    return stats.median_mad(p1m(spark, d))


_HIST_SQL = f"""
SELECT series_id, bin, lo + (bin - 1) * ((hi - lo) / 50.0) AS bin_lo, lo + bin * ((hi - lo) / 50.0) AS bin_hi, count(*) AS count
FROM (SELECT p.series_id, r.lo, r.hi,
        CASE WHEN r.hi - r.lo = 0 THEN CAST(1 AS BIGINT)
             ELSE least(CAST(50 AS BIGINT), CAST(floor((p.value - r.lo) / (r.hi - r.lo) * 50) AS BIGINT) + 1) END AS bin
      FROM ({S.P1}) p JOIN (SELECT series_id, min(value) AS lo, max(value) AS hi FROM ({S.P1}) _r GROUP BY 1) r USING (series_id)
      WHERE p.value IS NOT NULL) _h
GROUP BY series_id, bin, lo, hi"""


@register("histogram", _HIST_SQL, ["bin_lo", "bin_hi"])
def q_histogram(spark, d):
    """AGG-04: 50 equal-width bins per series."""
    return stats.histogram(p1(spark, d), 50)


def _acf_sql(src, nlags):
    c = f"SELECT series_id, ts, seq, value FROM ({src}) _c WHERE value IS NOT NULL"
    dd = f"SELECT c.*, c.value - m.mu AS d, m.n FROM ({c}) c JOIN (SELECT series_id, avg(value) AS mu, count(*) AS n FROM ({c}) _m GROUP BY 1) m USING (series_id)"
    prods = ", ".join(f"d * lag(d, {k}) OVER ({S.W}) AS p{k}" for k in range(1, nlags + 1))
    pr = f"SELECT series_id, n, d * d AS p0, {prods} FROM ({dd}) _d"
    sums = ", ".join(f"sum(p{k}) AS s{k}" for k in range(nlags + 1))
    sm = f"SELECT series_id, any_value(n) AS n, {sums} FROM ({pr}) _p GROUP BY series_id"
    unions = " UNION ALL ".join(
        f"SELECT series_id, CAST({k} AS INTEGER) AS lag, coalesce(s{k}, 0.0) / nullif(s0, 0) AS acf, n FROM ({sm}) _s{k}"
        for k in range(nlags + 1)
    )
    return f"SELECT series_id, lag, acf FROM ({unions}) _u WHERE lag < n"


@register("acf", _acf_sql(S.P2, 50), ["acf"])
def q_acf(spark, d):
    """AGG-05: autocorrelation, lags 0..50, of each hourly series (NULLs dropped)."""
    return stats.acf(p2(spark, d), 50)


@register("acf_users", _acf_sql(S.P1M, 10), ["acf"])
def q_acf_users(spark, d):
    """AGG-05, lags 0..10, per user with missing values dropped."""
    return stats.acf(p1m(spark, d), 10)


@register(
    "anomaly_rate",
    f"SELECT series_id, count(*) AS n, count(outlier) AS n_scored, CAST(count_if(coalesce(outlier, false)) AS BIGINT) AS n_anomalies, count_if(coalesce(outlier, false)) * 100.0 / count(*) AS rate_pct FROM ({S.iqr_flag(S.P1)}) _r GROUP BY series_id",
    ["rate_pct"],
)
def q_anomaly_rate(spark, d):
    """AGG-06: share of flagged rows (IQR flags) per series, in percent."""
    f = clean.outlier_iqr(p1(spark, d)).withColumnRenamed("outlier", "anomaly")
    return stats.anomaly_rate(f, "anomaly")


# ---------------------------------------------------------------- baseline forecasts, metrics, ensembles
_SPLIT = f"SELECT *, CASE WHEN ord < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split, CAST(floor(n * 0.8) AS BIGINT) AS n_train FROM ({S.with_n(S.with_ord(S.P2))}) _s"
_BASE_FC = f"""
WITH s AS ({_SPLIT}),
tr AS (SELECT * FROM s WHERE split = 'train'),
sizes AS (SELECT series_id, CAST(count_if(split = 'train') AS BIGINT) AS n_train, CAST(count_if(split = 'test') AS BIGINT) AS n_test FROM s GROUP BY 1),
agg AS (SELECT series_id, arg_max(value, CASE WHEN value IS NOT NULL THEN ord END) AS last, avg(value) AS mean FROM tr GROUP BY 1),
st AS (SELECT series_id, n_train, unnest(generate_series(1, n_test)) AS step FROM sizes WHERE n_test > 0),
x AS (SELECT st.series_id, st.step, agg.last, agg.mean, tr.value AS snaive
      FROM st LEFT JOIN agg USING (series_id)
      LEFT JOIN tr ON tr.series_id = st.series_id AND tr.ord = st.n_train - 24 + ((st.step - 1) % 24))
SELECT series_id, 'naive' AS model, CAST(step AS INTEGER) AS step, last AS forecast FROM x
UNION ALL SELECT series_id, 'mean', CAST(step AS INTEGER), mean FROM x
UNION ALL SELECT series_id, 'snaive', CAST(step AS INTEGER), snaive FROM x"""
_TEST = f"SELECT series_id, ts, CAST(ord - n_train + 1 AS INTEGER) AS step, value AS actual FROM ({_SPLIT}) _t WHERE split = 'test'"


def _baseline(spark, d):
    train, test, sizes = baselines.split_parts(p2(spark, d), 0.8)
    return train, test, sizes, baselines.baseline_forecasts(train, sizes, 24)


@register("baseline_forecast", _BASE_FC, ["forecast"])
def q_baseline_forecast(spark, d):
    """Deterministic naive / mean / seasonal-naive forecasts over each test horizon."""
    return _baseline(spark, d)[3]


@register(
    "forecast_metrics",
    f"""SELECT f.series_id, f.model, count(*) AS n_compared, avg(abs(f.forecast - t.actual)) AS mae,
       avg((f.forecast - t.actual) * (f.forecast - t.actual)) AS mse,
       sqrt(avg((f.forecast - t.actual) * (f.forecast - t.actual))) AS rmse
    FROM ({_BASE_FC}) f JOIN ({_TEST}) t ON f.series_id = t.series_id AND f.step = t.step
    WHERE t.actual IS NOT NULL AND f.forecast IS NOT NULL GROUP BY 1, 2""",
    ["mae", "mse", "rmse"],
)
def q_forecast_metrics(spark, d):
    """MET-01: MAE/MSE/RMSE per series and model against the held-out 20 %."""
    _, test, _, fc = _baseline(spark, d)
    return stats.forecast_metrics(test.select("series_id", "step", "actual"), fc)


@register(
    "ensemble_average",
    f"SELECT series_id, step, avg(forecast) AS forecast, count(forecast) AS n_members FROM ({_BASE_FC}) _e GROUP BY 1, 2",
    ["forecast"],
)
def q_ensemble_average(spark, d):
    """ENS-02: mean of the member forecasts per step (missing members skipped)."""
    return baselines.ensemble(_baseline(spark, d)[3], "average")


@register(
    "ensemble_median",
    f"SELECT series_id, step, quantile_cont(forecast, 0.5) AS forecast, count(forecast) AS n_members FROM ({_BASE_FC}) _e GROUP BY 1, 2",
    ["forecast"],
)
def q_ensemble_median(spark, d):
    """ENS-03: median of the member forecasts per step."""
    return baselines.ensemble(_baseline(spark, d)[3], "median")


@register(
    "ensemble_failed",
    f"SELECT series_id, step, avg(CASE WHEN step % 5 <> 0 AND NOT (model = 'naive' AND step % 3 = 0) THEN forecast END) AS forecast, "
    f"count(CASE WHEN step % 5 <> 0 AND NOT (model = 'naive' AND step % 3 = 0) THEN forecast END) AS n_members FROM ({_BASE_FC}) _e GROUP BY 1, 2",
    ["forecast"],
)
def q_ensemble_failed(spark, d):
    """ENS-02 with failed members: steps that all members failed stay, as NULL."""
    f = _baseline(spark, d)[3]
    failed = (F.col("step") % 5 == 0) | ((F.col("model") == "naive") & (F.col("step") % 3 == 0))
    return baselines.ensemble(f.withColumn("status", F.when(failed, "failed").otherwise("ok")), "average")


_CUSTOM_SQL = f"""
WITH s AS ({_SPLIT}), tr AS (SELECT * FROM s WHERE split = 'train'),
a AS (SELECT series_id, arg_max(value, CASE WHEN value IS NOT NULL THEN ord END) AS last, avg(value) AS mean, any_value(n_train) AS n_train FROM tr GROUP BY 1),
x AS (SELECT a.*, CAST(k AS INTEGER) AS step FROM a, unnest(generate_series(1, 30)) t(k)),
f AS (SELECT x.series_id, step, unnest([last, mean, tr.value]) AS forecast FROM x LEFT JOIN tr ON tr.series_id = x.series_id AND tr.ord = x.n_train - 24 + ((step - 1) % 24))
SELECT series_id, step, quantile_cont(forecast, 0.5) AS forecast, count(forecast) AS n_members FROM f GROUP BY 1, 2"""


@register("ensemble_custom", _CUSTOM_SQL, ["forecast"])
def q_ensemble_custom(spark, d):
    """ENS-01/03 with members of the user's choice: median of last value, mean and seasonal value, 30 steps."""
    from pulsegrid.operators import members

    train = baselines.split_parts(p2(spark, d), 0.8)[0].select("series_id", "ts", "seq", "value")
    return members.fit_members(train, [members.naive(), members.mean(), members.seasonal_naive(24)]).predict(30, "median")


@register(
    "overlay_forecast",
    f"""SELECT series_id, ts, value, 'train' AS role, CAST(ord - n_train + 1 AS INTEGER) AS step FROM ({_SPLIT}) _a WHERE split = 'train'
    UNION ALL SELECT series_id, ts, actual, 'test', step FROM ({_TEST}) _b
    UNION ALL SELECT f.series_id, t.ts, f.forecast, 'forecast:' || f.model, f.step FROM ({_BASE_FC}) f
      JOIN ({_TEST}) t ON f.series_id = t.series_id AND f.step = t.step""",
    ["value"],
)
def q_overlay_forecast(spark, d):
    """SET-02: train, test and forecasts stacked with a role tag. Forecast rows take
    their ts from the test rows; history rows carry step <= 0 (position before the origin)."""
    train, test, sizes, fc = _baseline(spark, d)
    tr = stats.attach(train, sizes.select("series_id", "n_train")).select(
        "series_id", "ts", "value", (F.col("ord") - F.col("n_train") + 1).cast("int").alias("step")
    )
    te = test.select("series_id", "ts", F.col("actual").alias("value"), "step")
    fts = fc.join(test.select("series_id", "step", "ts"), ["series_id", "step"]).select(
        "series_id", "ts", F.col("forecast").alias("value"), "step", F.concat(F.lit("forecast:"), "model").alias("_role")
    )
    return setops.overlay({"train": tr, "test": te}).unionByName(fts.withColumnRenamed("_role", "role"))


# ---------------------------------------------------------------- scaling of features, decomposition
_FEAT_COLS = S.FEATURES


def _scale_sql():
    f = S.features(S.P1)
    stats_cols = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEAT_COLS)
    scaled = ", ".join(
        f"(f.{c} - s.m_{c}) / (CASE WHEN s.s_{c} = 0 THEN 1.0 ELSE s.s_{c} END) AS {c}" for c in _FEAT_COLS
    )
    return f"SELECT f.series_id, f.ts, f.seq, {scaled} FROM ({f}) f JOIN (SELECT series_id, {stats_cols} FROM ({f}) _x GROUP BY 1) s USING (series_id)"


@register("scale_features", _scale_sql(), _FEAT_COLS)
def q_scale_features(spark, d):
    """NRM-04: detector features standardised with stored per-series mean / population std."""
    feats = rolling.anomaly_features(p1(spark, d))
    model = clean.fit_scaler(feats, _FEAT_COLS)
    return clean.apply_scaler(feats, model, _FEAT_COLS)


def _decomp_sql(src, period, model):
    c = f"SELECT * FROM ({src}) _c WHERE value IS NOT NULL"
    t = S.with_n(S.with_ord(_cma_sql(c, period)))
    if model == "additive":
        det, seas, resid = "value - trend", "pa - pm", "value - trend - seasonal"
    else:
        det, seas, resid = "value / nullif(trend, 0)", "pa / nullif(pm, 0)", "(value / nullif(trend, 0)) / nullif(seasonal, 0)"
    ph = f"SELECT series_id, ord % {period} AS ph, avg({det}) AS pa FROM ({t}) _t GROUP BY 1, 2"
    ph2 = f"SELECT series_id, ph, {seas} AS seasonal FROM (SELECT *, avg(pa) OVER (PARTITION BY series_id) AS pm FROM ({ph}) _p) _q"
    j = f"SELECT t.*, p.seasonal FROM ({t}) t LEFT JOIN ({ph2}) p ON t.series_id = p.series_id AND t.ord % {period} = p.ph"
    ok = f"n >= {2 * period}" + (" AND vmin > 0" if model == "multiplicative" else "")
    j = f"SELECT *, min(value) OVER (PARTITION BY series_id) AS vmin FROM ({j}) _v"
    return (
        f"SELECT series_id, ts, seq, value, CASE WHEN {ok} THEN trend END AS trend, CASE WHEN {ok} THEN seasonal END AS seasonal, "
        f"CASE WHEN {ok} THEN {resid} END AS resid FROM ({j}) _j"
    )


@register("decompose_additive", _decomp_sql(S.P2, 24, "additive"), ["value", "trend", "seasonal", "resid"])
def q_decompose_additive(spark, d):
    """DEC-01: additive classical decomposition of each hourly series (period 24)."""
    return decompose.decompose(p2(spark, d), 24, "additive")


@register(
    "decompose_multiplicative", _decomp_sql(S.P2, 24, "multiplicative"), ["value", "trend", "seasonal", "resid"]
)
def q_decompose_multiplicative(spark, d):
    """DEC-02: multiplicative classical decomposition (period 24)."""
    return decompose.decompose(p2(spark, d), 24, "multiplicative")


_SIGNED = f"SELECT series_id, ts, seq, CASE WHEN series_id < 'm' THEN value - 1000.0 ELSE value END AS value FROM ({S.P2}) _g"


@register("decompose_signed", _decomp_sql(_SIGNED, 24, "multiplicative"), ["value", "trend", "seasonal", "resid"])
def q_decompose_signed(spark, d):
    """DEC-02 where some series are not positive: these get NULL components."""
    x = p2(spark, d).withColumn("value", F.when(F.col("series_id") < "m", F.col("value") - 1000.0).otherwise(F.col("value")))
    return decompose.decompose(x, 24, "multiplicative")


@register("decompose_daily", _decomp_sql(S.P3, 7, "additive"), ["value", "trend", "seasonal", "resid"], bits=4)
def q_decompose_daily(spark, d):
    """DEC-01 on daily order revenue with the period implied by the daily frequency (7)."""
    return decompose.decompose(p3(spark, d), None, "additive")


@register("decompose_users", _decomp_sql(S.P1M, 7, "additive"), ["value", "trend", "seasonal", "resid"])
def q_decompose_users(spark, d):
    """DEC-01 per user with period 7 (short series get NULL components)."""
    return decompose.decompose(p1m(spark, d), 7, "additive")


# ---------------------------------------------------------------- scalar functions
_SCALAR_SQL = """
SELECT event_id, abs(value - 10.0) AS f_abs, sqrt(abs(value)) AS f_sqrt, sin(value) AS f_sin, power(value, 2) AS f_pow,
  CAST(floor(value) AS BIGINT) AS f_floor, event_id % 7 AS f_mod, lower(event_type) AS f_lower, upper(event_type) AS f_upper,
  concat_ws('_', event_type, CAST(user_id AS VARCHAR)) AS f_id, printf('%.3f', value) AS f_fmt,
  strftime(ts, '%Y%m%d_%H%M%S') AS f_stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS f_iso,
  CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS f_parsed,
  coalesce(CASE WHEN event_id % 7 <> 0 THEN value END, -1.0) AS f_coalesce,
  CAST(json_extract(props, '$.k') AS BIGINT) AS f_json_k
FROM events"""


@register("scalar_functions", _SCALAR_SQL, ["f_abs", "f_sqrt", "f_sin", "f_pow", "f_coalesce"])
def q_scalar_functions(spark, d):
    """Scalar functions used across the library: math, string, date, json, null handling."""
    ev = panels.table(spark, d, "events")
    v = F.col("value")
    return ev.select(
        "event_id",
        F.abs(v - 10.0).alias("f_abs"),
        F.sqrt(F.abs(v)).alias("f_sqrt"),
        F.sin(v).alias("f_sin"),
        F.pow(v, 2).alias("f_pow"),
        F.floor(v).cast("long").alias("f_floor"),
        (F.col("event_id") % 7).alias("f_mod"),
        F.lower("event_type").alias("f_lower"),
        F.upper("event_type").alias("f_upper"),
        F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("f_id"),
        F.format_string("%.3f", v).alias("f_fmt"),
        F.date_format("ts", "yyyyMMdd_HHmmss").alias("f_stamp"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("f_iso"),
        F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("f_parsed"),
        F.coalesce(F.when(F.col("event_id") % 7 != 0, v), F.lit(-1.0)).alias("f_coalesce"),
        F.get_json_object("props", "$.k").cast("long").alias("f_json_k"),
    )


# ---------------------------------------------------------------- models (rows-only: no SQL oracle)

from pulsegrid.operators import anomaly, forecast  # noqa: E402
from pulsegrid.plans.lineage import materialize  # noqa: E402


def _hourly_clean(spark, d):
    return clean.interpolate(p2(spark, d), "linear").filter(F.col("value").isNotNull())


_LAGGED = "SELECT *, lag(value, {k}) OVER (PARTITION BY series_id ORDER BY ts, seq) AS y1 FROM ({src}) _l"
_ADF0 = f"""
SELECT series_id, n, slope / sqrt((syy - slope * sxy) / (m - 2) / sxx) AS t_stat, -2.8621 - 2.738 / n - 8.36 / (n * n) AS crit_5pct FROM (
  SELECT series_id, count(*) AS n, count(y1) AS m, regr_slope(value - y1, y1) AS slope, regr_sxx(value - y1, y1) AS sxx, regr_syy(value - y1, y1) AS syy, regr_sxy(value - y1, y1) AS sxy
  FROM ({_LAGGED.format(k=1, src=S.P1)}) _a GROUP BY 1) _b"""


@register("adf_lag0", _ADF0, ["t_stat", "crit_5pct"], bits=16)
def q_adf_lag0(spark, d):
    """STA-01 without lagged differences: the Dickey-Fuller regression of every user series."""
    return forecast.adf_test(p1(spark, d), lags=0).select("series_id", "n", "t_stat", "crit_5pct")


def _ar1_sql(src, k=1):
    return f"""
SELECT series_id, const, ar, sse / n AS sigma2, n, n * (ln(2 * pi() * sse / n) + 1) + 6 AS aic, n * (ln(2 * pi() * sse / n) + 1) + 3 * ln(n) AS bic, last FROM (
  SELECT series_id, regr_intercept(value, y1) AS const, regr_slope(value, y1) AS ar, count(y1) AS n,
    regr_syy(value, y1) - regr_slope(value, y1) * regr_sxy(value, y1) AS sse, arg_max(value, (ts, seq)) AS last
  FROM ({_LAGGED.format(k=k, src=src)}) _a GROUP BY 1) _b"""


def _ar_rows(models, lag=1):
    p = F.col("params")
    return models.select("series_id", p["const"].alias("const"), p[f"ar.L{lag}"].alias("ar"), p["sigma2"].alias("sigma2"), "n", "aic", "bic")


_HOURLY = f"SELECT * FROM ({S.interpolate(S.P2, 'linear')}) _h WHERE value IS NOT NULL"


@register("arima_100", f"SELECT * EXCLUDE (last) FROM ({_ar1_sql(S.P1)}) _x", ["const", "ar", "sigma2", "aic", "bic"], bits=12)
def q_arima_100(spark, d):
    """FC-01/04: AR(1) with constant of every user series: coefficients, variance, AIC and BIC."""
    return _ar_rows(forecast.arima_fit(p1(spark, d), (1, 0, 0), auto_stationary=False))


@register("sarima_100_24", f"SELECT * EXCLUDE (last) FROM ({_ar1_sql(_HOURLY, 24)}) _x", ["const", "ar", "sigma2", "aic", "bic"], bits=12)
def q_sarima_100_24(spark, d):
    """FC-02/04: seasonal autoregression of lag 24 of every hourly series."""
    return _ar_rows(forecast.arima_fit(_hourly_clean(spark, d), (0, 0, 0), (1, 0, 0, 24), auto_stationary=False), 24)


@register(
    "arima_100_forecast",
    f"""SELECT series_id, CAST(h AS INTEGER) AS step, const * (1 - power(ar, h)) / (1 - ar) + power(ar, h) * last AS forecast,
        const * (1 - power(ar, h)) / (1 - ar) + power(ar, h) * last - 1.959963984540054 * sqrt(sigma2 * (1 - power(ar, 2 * h)) / (1 - ar * ar)) AS lo
    FROM ({_ar1_sql(_HOURLY)}) _x, unnest(generate_series(1, 24)) t(h)""",
    ["forecast", "lo"],
    bits=12,
)
def q_arima_100_forecast(spark, d):
    """FC-03: 24 steps of the AR(1) of every hourly series with the lower bound."""
    m = forecast.arima_fit(_hourly_clean(spark, d), (1, 0, 0), auto_stationary=False)
    return forecast.arima_forecast(m, 24).select("series_id", "step", "forecast", "lo")


_LINE = f"""
SELECT series_id, regr_intercept(value, x) AS b0, regr_slope(value, x) AS b1, count(*) AS n, max(ts) AS last_ts FROM (
  SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY series_id)) / nullif((max(epoch_us(ts)) OVER (PARTITION BY series_id) - min(epoch_us(ts)) OVER (PARTITION BY series_id))::DOUBLE, 0) AS x
  FROM ({_HOURLY}) _a) _b GROUP BY 1"""


def _line(spark, d):
    return forecast.trend_season_fit(_hourly_clean(spark, d), yearly=False, weekly=False, daily=False, changepoints=0)


@register("trend_line_fit", f"SELECT series_id, b0, b1, n, 'ok' AS status FROM ({_LINE}) _x", ["b0", "b1"], bits=12)
def q_trend_line_fit(spark, d):
    """FC-05/07: the trend alone (no seasonality, no changepoints) is a straight line."""
    return _line(spark, d).select("series_id", F.col("params")["b0"].alias("b0"), F.col("params")["b1"].alias("b1"), "n", "status")


@register(
    "trend_line_forecast",
    f"""SELECT series_id, CAST(h AS INTEGER) AS step, last_ts + h * INTERVAL 1 HOUR AS ts, b0 + b1 * (1 + h * 3600000000 / span) AS forecast
    FROM (SELECT _x.*, (SELECT (max(epoch_us(ts)) - min(epoch_us(ts)))::DOUBLE FROM ({_HOURLY}) _y WHERE _y.series_id = _x.series_id) AS span FROM ({_LINE}) _x) _z,
      unnest(generate_series(1, 12)) t(h)""",
    ["forecast"],
    bits=12,
)
def q_trend_line_forecast(spark, d):
    """FC-06: 12 future rows of the straight line, one modal step apart."""
    return forecast.trend_season_forecast(_line(spark, d), 12, history=_hourly_clean(spark, d)).select("series_id", "step", "ts", "forecast")


@register("adf_test")
def q_adf_test(spark, d):
    """STA-01: ADF t-statistic, AIC lag choice and 5 % decision per user series."""
    return forecast.adf_test(p1(spark, d))


@register("auto_difference")
def q_auto_difference(spark, d):
    """STA-02: differencing order 0..2 per series chosen in one job."""
    return forecast.auto_difference(p1(spark, d))


def _arima(spark, d):
    return forecast.arima_fit(_hourly_clean(spark, d), (1, 1, 1))


@register("arima_fit")
def q_arima_fit(spark, d):
    """FC-01: ARIMA(1,1,1) after auto differencing, every hourly series in one job."""
    return _arima(spark, d).drop("state")


@register("sarima_fit")
def q_sarima_fit(spark, d):
    """FC-02: seasonal ARIMA(1,0,1)(1,1,0,24)."""
    return forecast.arima_fit(_hourly_clean(spark, d), (1, 0, 1), (1, 1, 0, 24), auto_stationary=False).drop("state")


@register("arima_forecast")
def q_arima_forecast(spark, d):
    """FC-03: 48-step forecasts with intervals, on both scales."""
    return forecast.arima_forecast(_arima(spark, d), 48)


@register("arima_info")
def q_arima_info(spark, d):
    """FC-04: order, seasonal order, AIC, BIC, status per series."""
    return _arima(spark, d).select("series_id", "model", "order", "seasonal_order", "aic", "bic", "n", "status")


@register("arima_users")
def q_arima_users(spark, d):
    """FC-01 on the 150+ irregular per-user series (panel scale-out)."""
    return forecast.arima_fit(p1(spark, d), (1, 0, 1)).drop("state")


@register("trend_season_fit")
def q_trend_season_fit(spark, d):
    """FC-05/07: trend + yearly/weekly/daily Fourier regression per series."""
    return forecast.trend_season_fit(_hourly_clean(spark, d)).drop("state")


# fewer rows than coefficients or no spread of time: no fit
_USER_LINE = f"""
SELECT series_id, b0, b1, CASE WHEN b1 IS NULL THEN 'failed' ELSE 'ok' END AS status, n FROM ({_LINE.replace(_HOURLY, S.P1)}) _x"""


@register("trend_season_users", _USER_LINE, ["b0", "b1"], bits=12)
def q_trend_season_users(spark, d):
    """FC-05: the trend of every user series; series too short for it are kept with their status."""
    m = forecast.trend_season_fit(p1(spark, d), yearly=False, weekly=False, daily=False, changepoints=0)
    return m.select("series_id", F.col("params")["b0"].alias("b0"), F.col("params")["b1"].alias("b1"), "status", "n")


@register("trend_season_forecast")
def q_trend_season_forecast(spark, d):
    """FC-06: future rows only, step = modal gap of each series."""
    h = _hourly_clean(spark, d)
    return forecast.trend_season_forecast(forecast.trend_season_fit(h), 48, history=h)


def _members():
    from pulsegrid.operators import members

    return [members.arima(), members.trend_season()]


@register("ensemble_fit", f"SELECT series_id, unnest(['arima', 'trend_season']) AS model, 'ok' AS status FROM (SELECT DISTINCT series_id FROM ({S.P2}) _e) _f")
def q_ensemble_fit(spark, d):
    """ENS-01: both members fitted on every series; failures would be kept as status rows."""
    from pulsegrid.operators import members

    return members.fit_members(_hourly_clean(spark, d), _members()).status()


@register("ensemble_models")
def q_ensemble_models(spark, d):
    """ENS-02 over model forecasts: mean of ARIMA and trend-season forecasts per step."""
    from pulsegrid.operators import members

    return members.fit_members(_hourly_clean(spark, d), _members()).predict(24, "average")


def _iforest(spark, d):
    feats = rolling.anomaly_features(p1(spark, d))
    scaler = clean.fit_scaler(feats, _FEAT_COLS)
    scaled = clean.apply_scaler(feats, scaler, _FEAT_COLS)
    # scores feed both the per-series cut and the flags: written once, read twice
    return materialize(anomaly.iforest_scores(scaled, _FEAT_COLS, 100, 256, 42), "iforest_scores")


@register("iforest_fit")
def q_iforest_fit(spark, d):
    """ANO-02: node table of 100 isolation trees per user series."""
    feats = rolling.anomaly_features(p1(spark, d))
    scaled = clean.apply_scaler(feats, clean.fit_scaler(feats, _FEAT_COLS), _FEAT_COLS)
    return anomaly.forest_nodes(anomaly.iforest_fit(scaled, _FEAT_COLS))


@register("iforest_detect")
def q_iforest_detect(spark, d):
    """ANO-03: scores and flags at contamination 0.1."""
    scores = _iforest(spark, d)
    return anomaly.flag(scores, anomaly.threshold(scores, 0.1))


_SCORED = f"SELECT p.series_id, count(*) AS n, count(f.series_id) AS n_scored FROM ({S.P1}) p LEFT JOIN ({S.features(S.P1)}) f ON p.series_id = f.series_id AND p.ts = f.ts AND p.seq = f.seq GROUP BY 1"


@register("iforest_scored", f"SELECT *, n_scored > 0 AS modelled FROM ({_SCORED}) _x")
def q_iforest_scored(spark, d):
    """ANO-02/03: rows scored per series; warm-up rows are not, and every scored row lies in (0, 1)."""
    scores = _iforest(spark, d)
    base = p1(spark, d).join(scores.where("score > 0 and score < 1"), ["series_id", "ts", "seq"], "left")
    seen = base.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("n_scored"))
    return seen.withColumn("modelled", F.col("n_scored") > 0)


@register("iforest_model", f"SELECT series_id, 'isolation_forest' AS model, n_scored AS n, 0.1 AS contamination, 100.0 AS n_trees, CAST(least(n_scored, 256) AS DOUBLE) AS max_samples, 'ok' AS status FROM ({_SCORED}) _x WHERE n_scored > 0", ["contamination", "n_trees", "max_samples"])
def q_iforest_model(spark, d):
    """ANO-04/05: the stable columns of the model rows."""
    scores = _iforest(spark, d)
    p = F.col("params")
    info = anomaly.model_info(anomaly.threshold(scores, 0.1), 0.1)
    return info.select("series_id", "model", "n", p["contamination"].alias("contamination"), p["n_trees"].alias("n_trees"), p["max_samples"].alias("max_samples"), "status")


@register("iforest_threshold")
def q_iforest_threshold(spark, d):
    """ANO-04: flags re-derived from stored scores at contamination 0.05 (no refit)."""
    scores = _iforest(spark, d)
    return anomaly.flag(scores, anomaly.threshold(scores, 0.05))


@register("iforest_info")
def q_iforest_info(spark, d):
    """ANO-05: model row per series."""
    scores = _iforest(spark, d)
    return anomaly.model_info(anomaly.threshold(scores, 0.1), 0.1)


@register("iforest_anomaly_rate")
def q_iforest_anomaly_rate(spark, d):
    """AGG-06 on detector flags: unscored warm-up rows count as not anomalous (SEM-12/14)."""
    scores = _iforest(spark, d)
    flags = anomaly.flag(scores, anomaly.threshold(scores, 0.1)).select("series_id", "ts", "seq", "anomaly")
    base = p1(spark, d).join(flags, ["series_id", "ts", "seq"], "left")
    return stats.anomaly_rate(base, "anomaly")


# ---------------------------------------------------------------- streaming (rows-only; stream = batch is a test)
from pulsegrid import streaming  # noqa: E402
from pulsegrid.streaming import rolling_state  # noqa: E402
from pulsegrid.tables import experiments, registry  # noqa: E402


def _replay(spark, d, frame: DataFrame, tag: str, chunks: int = 4, **kw) -> DataFrame:
    """Stage ``frame`` as ``chunks`` time ranges of several files, replay them as micro-batches
    through the stateful operator, return the sink table."""
    root = shared_dir(spark, "streams", tag, unique=True)
    staged = frame if "is_reset" in frame.columns else frame.withColumn("is_reset", F.lit(False))
    rolling_state.stage_for_replay(staged, f"{root}/in", chunks)
    src = streaming.replay_source(spark, f"{root}/in")
    out = rolling_state.stream_rolling(src, **kw)
    streaming.run_to_table(out, f"{root}/out", f"{root}/chk")
    return spark.read.parquet(f"{root}/out")


# Stream = batch: the streamed statistics equal the batch windows, so the batch SQL is their oracle.
_STREAM_ROLL_SQL = f"SELECT *, false AS late FROM ({S.rolling_stats(S.P1M, 30)}) _s"
_STREAM_REPLAY_SQL = f"SELECT series_id, ts, seq, mean, current, window_size FROM ({S.rolling_stats(S.P1, 50)}) _s"
_STREAM_BAND_SQL = f"""
SELECT b.series_id, b.ts, b.seq, b.value AS current, z.mean_zero_pad, b.mean AS band_mean, b.band_lo, b.band_hi
FROM ({_band_sql(S.P1)}) b JOIN (
  SELECT series_id, ts, seq, coalesce(sum(value) OVER ({S.W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0.0) / 30.0 AS mean_zero_pad
  FROM ({S.P1}) _p) z ON b.series_id = z.series_id AND b.ts = z.ts AND b.seq = z.seq"""
_WD = "PARTITION BY series_id, date_trunc('day', ts) ORDER BY ts, seq ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"
_STREAM_RESET_SQL = f"""
SELECT series_id, ts, seq,
  CASE WHEN count(value) OVER ({_WD}) = count(*) OVER ({_WD}) THEN avg(value) OVER ({_WD}) END AS mean,
  CASE WHEN count(value) OVER ({_WD}) = count(*) OVER ({_WD}) THEN stddev_pop(value) OVER ({_WD}) END AS std,
  value AS current, count(*) OVER ({_WD}) AS window_size, false AS late
FROM ({S.P1}) _r"""


@register("stream_rolling_stats", _STREAM_ROLL_SQL, S.ROLLING_DOUBLES)
def q_stream_rolling_stats(spark, d):
    """STR-01/05: per-arrival trailing-30 stats over 4 replayed micro-batches (equals WIN-01)."""
    return _replay(spark, d, p1m(spark, d), "rolling", window=30).select(
        "series_id", "ts", "seq", "mean", "std", "min", "max", "median", "current", "window_size", "late"
    )


@register("stream_replay", _STREAM_REPLAY_SQL, ["mean", "current"])
def q_stream_replay(spark, d):
    """SRC-05: chunked replay of the stored panel as micro-batches (a few files a trigger)."""
    return _replay(spark, d, p1(spark, d), "replay", chunks=8, window=50).select("series_id", "ts", "seq", "mean", "current", "window_size")


@register("stream_band", _STREAM_BAND_SQL, ["current", "mean_zero_pad", "band_mean", "band_lo", "band_hi"])
def q_stream_band(spark, d):
    """STR-04: zero-padded mean (N=30) and trailing mean + padded band (N=50) live."""
    return _replay(spark, d, p1(spark, d), "band", window=30, band_window=50).select(
        "series_id", "ts", "seq", "current", "mean_zero_pad", "band_mean", "band_lo", "band_hi"
    )


def _with_daily_resets(frame: DataFrame) -> DataFrame:
    """Control rows derived from the data: one reset at the start of every day a series is active (after its first)."""
    days = frame.select("series_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")).distinct()
    first = frame.groupBy("series_id").agg(F.min(F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("_d0"))
    resets = days.join(first, "series_id").filter(F.col("ts") > F.col("_d0")).select(
        "series_id", "ts", F.lit(-1).cast("long").alias("seq"), F.lit(None).cast("double").alias("value"), F.lit(True).alias("is_reset")
    )
    return frame.withColumn("is_reset", F.lit(False)).unionByName(resets)


@register("stream_reset", _STREAM_RESET_SQL, ["mean", "std", "current"])
def q_stream_reset(spark, d):
    """STR-03: buffers cleared by control rows (daily resets derived from the data)."""
    return _replay(spark, d, _with_daily_resets(p1(spark, d)), "reset", window=30).select(
        "series_id", "ts", "seq", "mean", "std", "current", "window_size", "late"
    )


@register(
    "stream_current_stats",
    f"SELECT series_id, arg_max(ts, (ts, seq)) AS ts, arg_max(seq, (ts, seq)) AS seq, arg_max(mean, (ts, seq)) AS mean, arg_max(std, (ts, seq)) AS std, arg_max(min, (ts, seq)) AS min, arg_max(max, (ts, seq)) AS max, arg_max(median, (ts, seq)) AS median, arg_max(current, (ts, seq)) AS current, arg_max(window_size, (ts, seq)) AS window_size FROM ({S.rolling_stats(S.P1, 30)}) _s GROUP BY series_id",
    S.ROLLING_DOUBLES,
)
def q_stream_current_stats(spark, d):
    """STR-02: foreachBatch keeps an append-only snapshot; the view is the newest row per series."""
    root = shared_dir(spark, "streams", "current", unique=True)
    rolling_state.stage_for_replay(p1(spark, d).withColumn("is_reset", F.lit(False)), f"{root}/in", 4)
    out = rolling_state.stream_rolling(streaming.replay_source(spark, f"{root}/in"), window=30)
    streaming.run_to_table(out, None, f"{root}/chk", foreach=rolling_state.snapshot_writer(f"{root}/snap"))
    return streaming.current_stats_view(spark, f"{root}/snap").select(
        "series_id", "ts", "seq", "mean", "std", "min", "max", "median", "current", "window_size"
    )


# ---------------------------------------------------------------- registry, experiments, manifests (rows-only)
def _models(spark, d):
    return forecast.trend_season_fit(_hourly_clean(spark, d), yearly=False)


_FITTED = f"SELECT series_id, count(*) AS n FROM ({S.P2}) _r GROUP BY 1"
_LOADED = "SELECT series_id, 'trend_season' AS model, 'trend_season' AS model_name, '{v}' AS version, 'ok' AS status, n FROM (" + _FITTED + ") _l"


@register("registry_save", _LOADED.format(v="001"))
def q_registry_save(spark, d):
    """REG-01: save per-series models under a name and version; returns the stored rows."""
    root = shared_dir(spark, "registry", unique=True)
    name, version = registry.save_model(_models(spark, d), root, "trend_season", "001", {"panel": "hourly"})
    return registry.load_model(spark, root, name, version).select("series_id", "model", "model_name", "version", "status", "n")


@register("registry_load", _LOADED.format(v="1"))
def q_registry_load(spark, d):
    """REG-02: latest version of a model, beside another model of another schema."""
    root = shared_dir(spark, "registry", unique=True)
    m = _models(spark, d)
    registry.save_model(m, root, "trend_season", "1.0")
    registry.save_model(m, root, "trend_season", "1")
    registry.save_model(m.select("series_id", F.lit(1).alias("scale")), root, "scaler", "1")
    return registry.load_model(spark, root, "trend_season").select("series_id", "model", "model_name", "version", "status", "n")


_PLACED = "SELECT model_name, version, rows, n_fitted, source, row_number() OVER (ORDER BY nth DESC) AS place FROM ({}) _p"


def _placed(df):
    stamp = F.row_number().over(Window.orderBy(F.desc("saved_at")))  # one row a save
    return df.select("model_name", "version", "rows", "n_fitted", F.col("metadata")["source"].alias("source"), stamp.cast("long").alias("place"))


@register(
    "registry_list",
    _PLACED.format(
        f"SELECT 'trend_season' AS model_name, 'v1' AS version, count(*) AS rows, count(*) AS n_fitted, 'hourly' AS source, 1 AS nth FROM ({_FITTED}) _a "
        f"UNION ALL SELECT 'scaler', 'v1', {len(_FEAT_COLS)} * count(DISTINCT series_id), {len(_FEAT_COLS)} * count(DISTINCT series_id), NULL, 2 FROM ({S.features(S.P1)}) _b"
    ),
)
def q_registry_list(spark, d):
    """REG-03 + AGG-07: two models listed newest first with fitted counts."""
    root = shared_dir(spark, "registry", unique=True)
    registry.save_model(_models(spark, d), root, "trend_season", "v1", {"source": "hourly"})
    feats = rolling.anomaly_features(p1(spark, d))
    registry.save_model(clean.fit_scaler(feats, _FEAT_COLS).withColumn("status", F.lit("ok")), root, "scaler", "v1")
    return _placed(registry.list_checkpoints(spark, root))


@register(
    "registry_delete",
    _PLACED.format(
        f"SELECT 'trend_season' AS model_name, 'v1' AS version, count(*) AS rows, count(*) AS n_fitted, 'again' AS source, 2 AS nth FROM ({_FITTED}) _a "
        f"UNION ALL SELECT 'trend_season', 'v3', count(*), count(*), NULL, 1 FROM ({_FITTED}) _b"
    ),
)
def q_registry_delete(spark, d):
    """REG-04: deleted versions are not listed; one of them is saved again and is."""
    root = shared_dir(spark, "registry", unique=True)
    m = _models(spark, d)
    for v in ("v1", "v2", "v3"):
        registry.save_model(m, root, "trend_season", v)
    registry.delete_checkpoint(spark, root, "trend_season", "v1")
    registry.delete_checkpoint(spark, root, "trend_season", "v2")
    registry.save_model(m, root, "trend_season", "v1", {"source": "again"})
    return _placed(registry.list_checkpoints(spark, root, "trend_season"))


_METRICS_SQL = f"""SELECT f.series_id, f.model, count(*) AS n_compared, avg(abs(f.forecast - t.actual)) AS mae,
       avg((f.forecast - t.actual) * (f.forecast - t.actual)) AS mse,
       sqrt(avg((f.forecast - t.actual) * (f.forecast - t.actual))) AS rmse
    FROM ({_BASE_FC}) f JOIN ({_TEST}) t ON f.series_id = t.series_id AND f.step = t.step
    WHERE t.actual IS NOT NULL AND f.forecast IS NOT NULL GROUP BY 1, 2"""


def _experiment(spark, d, finish: bool = True):
    root = shared_dir(spark, "experiments", unique=True)
    exp_id = experiments.start_experiment(spark, root, "baselines", "baseline forecasts on the hourly panel", {"train_fraction": 0.8, "season": 24})
    _, test, _, fc = _baseline(spark, d)
    met = materialize(stats.forecast_metrics(test.select("series_id", "step", "actual"), fc), "experiment")
    long = met.select(F.explode(F.array(*[F.struct(F.concat_ws(".", "series_id", "model", F.lit(m)).alias("name"), F.col(m).alias("value")) for m in ("mae", "rmse")])).alias("m")).select("m.*")
    experiments.log_metrics(long.withColumn("step", F.lit(1)), root, exp_id)
    experiments.save_result(spark, root, exp_id, "metrics", met, "json")
    if finish:
        experiments.finish_experiment(spark, root, exp_id, {"models": 3})
    return root, exp_id, met.schema


_SETUP = "description string, parameters struct<train_fraction: double, season: bigint>"


@register("experiment_start", "SELECT 'start' AS kind, 'baselines' AS name, 'baseline forecasts on the hourly panel' AS description, 0.8::DOUBLE AS train_fraction, 24::BIGINT AS season, '{\"train_fraction\":0.8,\"season\":24}' AS parameters", ["train_fraction"])
def q_experiment_start(spark, d):
    """EXP-01: start event; its parameters from JSON and back to it."""
    root, exp_id, _ = _experiment(spark, d, finish=False)
    ev = spark.read.schema(experiments.EVENTS).parquet(f"{root}/events").filter((F.col("kind") == "start") & (F.col("experiment_id") == exp_id))
    p = F.from_json("payload", _SETUP).alias("p")
    return ev.select("kind", "name", p).select("kind", "name", "p.description", "p.parameters.train_fraction", "p.parameters.season", F.to_json("p.parameters").alias("parameters"))


@register("experiment_metrics", f"SELECT series_id || '.' || model || '.mae' AS name, mae AS value, 1 AS step FROM ({_METRICS_SQL}) _a UNION ALL SELECT series_id || '.' || model || '.rmse', rmse, 1 FROM ({_METRICS_SQL}) _b", ["value"])
def q_experiment_metrics(spark, d):
    """EXP-02: metric rows appended by the executors."""
    root, exp_id, _ = _experiment(spark, d)
    return experiments.metrics_of(spark, root, exp_id).select("name", "value", "step")


@register("experiment_result", _METRICS_SQL, ["mae", "mse", "rmse"])
def q_experiment_result(spark, d):
    """EXP-03: result table written under the experiment and read back with its schema."""
    root, exp_id, schema = _experiment(spark, d)
    return files.read_frame(spark, f"{root}/results/{exp_id}/metrics", "json", schema)


@register("experiment_finish", "SELECT 'finish' AS kind, 3::BIGINT AS models")
def q_experiment_finish(spark, d):
    """EXP-04: finish event with the final results."""
    root, _, _ = _experiment(spark, d)
    ev = spark.read.schema(experiments.EVENTS).parquet(f"{root}/events")
    return ev.filter(F.col("kind") == "finish").select("kind", F.from_json("payload", "models bigint")["models"].alias("models"))


@register("experiment_list", f"SELECT 'baselines' AS name, 'completed' AS status, 2 * count(*) AS n_metrics, 1::BIGINT AS n_results, true AS in_order, 3::BIGINT AS models FROM ({_METRICS_SQL}) _a")
def q_experiment_list(spark, d):
    """EXP-05: latest state of all experiments."""
    root, _, _ = _experiment(spark, d)
    found = experiments.list_experiments(spark, root)
    return found.select("name", "status", "n_metrics", "n_results", (F.col("started") <= F.col("updated")).alias("in_order"), F.from_json("final_results", "models bigint")["models"].alias("models"))


@register("dataset_manifest", f"SELECT 'hourly_by_type' AS name, 'parquet' AS format, count(*) AS rows, 'events' AS source, 'series_id,ts,seq,value' AS columns FROM ({S.P2}) _m")
def q_dataset_manifest(spark, d):
    """SNK-03: manifest row (name, time, format, rows, schema) written with the data."""
    path = shared_dir(spark, "datasets", "manifest", unique=True)
    row = files.save_dataset(p2(spark, d), path, "hourly_by_type", {"source": "events"}, "parquet")
    fields = F.from_json("schema_json", "fields array<struct<name: string>>")["fields"]["name"]
    return row.select("name", "format", "rows", F.col("metadata")["source"].alias("source"), F.array_join(fields, ",").alias("columns"))


# ---------------------------------------------------------------- the blocked (hot-series) plan under the oracle
# Same operators and oracles as above, with the plan forced to 'blocked' and small
# blocks so that every series spans many blocks: the long-series path is checked
# against SQL at the check scale, not only in tests.
from pulsegrid.plans.blocked import forced_blocks  # noqa: E402


@register("rolling_stats_blocked", S.rolling_stats(S.P4, 30), S.ROLLING_DOUBLES)
def q_rolling_stats_blocked(spark, d):
    """WIN-01 on the single long series through halo blocks of 1,024 rows."""
    with forced_blocks(1024):
        return rolling.rolling_stats(p4(spark, d), 30, plan="blocked")


# nine of ten events of a day at its first second; all events at one time
_BURSTY = f"SELECT series_id, CASE WHEN seq % 10 = 0 THEN ts ELSE date_trunc('day', ts) END AS ts, seq, value FROM ({S.P4}) _u"
_TIED = f"SELECT series_id, TIMESTAMP '2024-01-01 00:00:00' AS ts, seq, value FROM ({S.P4}) _u"


@register("rolling_bursty", S.rolling_stats(_BURSTY, 30), S.ROLLING_DOUBLES)
def q_rolling_bursty(spark, d):
    """WIN-01 through blocks where most rows of a day share one time."""
    x = p4(spark, d)
    ts = F.when(F.col("seq") % 10 == 0, F.col("ts")).otherwise(F.date_trunc("day", "ts").cast("timestamp_ntz"))
    with forced_blocks(1024):
        return rolling.rolling_stats(x.withColumn("ts", ts), 30, plan="blocked")


@register("rolling_tied", S.rolling_stats(_TIED, 30), S.ROLLING_DOUBLES)
def q_rolling_tied(spark, d):
    """WIN-01 through blocks where all rows share one time: the order is that of ``seq``."""
    x = p4(spark, d)
    with forced_blocks(1024):
        return rolling.rolling_stats(x.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), 30, plan="blocked")


@register("anomaly_features_blocked", S.features(S.P4), S.FEATURES)
def q_anomaly_features_blocked(spark, d):
    """ANO-01 on the single long series through halo blocks."""
    with forced_blocks(1024):
        return rolling.anomaly_features(p4(spark, d), plan="blocked")


@register("row_ordinal_blocked", S.with_ord(S.P4), ["value"])
def q_row_ordinal_blocked(spark, d):
    """PRJ-04 exact global positions from time buckets and prefix offsets."""
    with forced_blocks(1024):
        return columns.row_ordinal(p4(spark, d), plan="blocked")


@register("interp_linear_blocked", S.interpolate(S.P1M, "linear"), ["value"])
def q_interp_linear_blocked(spark, d):
    """IMP-01 with block summaries as carry-in (blocks of 16 rows per user series)."""
    with forced_blocks(16):
        return clean.interpolate(p1m(spark, d), "linear", plan="blocked")


@register("median_mad_blocked", S.median_mad(S.P1M), ["median", "mad"])
def q_median_mad_blocked(spark, d):
    """AGG-03 through level-wise exact quantile refinement (sort limit 8 rows)."""
    with forced_blocks(16, sort_rows=8):
        return stats.median_mad(p1m(spark, d), plan="blocked")


@register(
    "iqr_bounds_blocked",
    f"SELECT series_id, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT series_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ({S.P4}) _a GROUP BY 1) _b",
    ["q1", "q3", "iqr", "lower", "upper"],
)
def q_iqr_bounds_blocked(spark, d):
    """AGG-02 on the single long series through exact quantile refinement."""
    with forced_blocks(1024, sort_rows=256):
        return stats.iqr_bounds(p4(spark, d), plan="blocked")


@register("decompose_blocked", _decomp_sql(S.P4, 24, "additive"), ["value", "trend", "seasonal", "resid"])
def q_decompose_blocked(spark, d):
    """DEC-01 of the single long series (period 24) with blocked windows and ordinals."""
    with forced_blocks(1024):
        return decompose.decompose(p4(spark, d), 24, "additive", plan="blocked")


# ---------------------------------------------------------------- end-to-end jobs
@register("forecast_job")
def q_forecast_job(spark, d):
    """3.1: 80/20 split -> ARIMA(1,1,1) after auto differencing and trend-season fits on
    train -> forecasts over each test horizon -> one CSV folder per model -> MAE/MSE/RMSE
    against the held-out rows (read back from the sink)."""
    h = _hourly_clean(spark, d)
    train, test, sizes = baselines.split_parts(h, 0.8)
    steps = int(sizes.agg(F.max("n_test")).first()[0] or 0)  # one scalar: the longest horizon
    tr = train.select("series_id", "ts", "seq", "value")
    fa = forecast.arima_forecast(forecast.arima_fit(tr, (1, 1, 1)), steps)
    ft = forecast.trend_season_forecast(forecast.trend_season_fit(tr), steps, history=tr)
    fc = fa.unionByName(ft).select("series_id", "model", "step", "ts", "forecast")
    path = shared_dir(spark, "jobs", "forecast", unique=True)
    files.write_frame(fc, path, "csv", partition_by=["model"])
    schema = T.StructType(
        [
            T.StructField("series_id", T.StringType()),
            T.StructField("step", T.IntegerType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("forecast", T.DoubleType()),
            T.StructField("model", T.StringType()),
        ]
    )
    back = files.read_frame(spark, path, "csv", schema)
    return stats.forecast_metrics(test.select("series_id", "step", "actual"), back)


@register("anomaly_job")
def q_anomaly_job(spark, d):
    """3.2: features once -> scaler -> forest fit -> score -> flags to CSV -> anomaly
    count and rate per series from the sink (unscored warm-up rows count as normal)."""
    scores = _iforest(spark, d)
    flags = anomaly.flag(scores, anomaly.threshold(scores, 0.1)).select("series_id", "ts", "seq", "anomaly")
    path = shared_dir(spark, "jobs", "anomaly", unique=True)
    files.write_frame(flags, path, "csv")
    schema = T.StructType(
        [
            T.StructField("series_id", T.StringType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("seq", T.LongType()),
            T.StructField("anomaly", T.BooleanType()),
        ]
    )
    back = files.read_frame(spark, path, "csv", schema)
    rows_ = p1(spark, d).join(back, ["series_id", "ts", "seq"], "left")
    return stats.anomaly_rate(rows_, "anomaly")


_COLLECTIONS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS series_id,
  list_slice(list_sort(list(value)), 1, 3)[1] AS low1,
  list_slice(list_sort(list(value)), 1, 3)[3] AS low3,
  list_sort(list(value))[-1] AS top,
  CAST(len(list_distinct(list(event_type))) AS BIGINT) AS n_types,
  map_from_entries([{'k': 'min', 'v': min(value)}, {'k': 'max', 'v': max(value)}])['max'] AS map_max,
  array_to_string(list_sort(list_distinct(list(event_type))), ',') AS types
FROM events GROUP BY 1"""


@register("scalar_collections", _COLLECTIONS_SQL, ["low1", "low3", "top", "map_max"])
def q_scalar_collections(spark, d):
    """Array/map functions used across the library: collect_list, array_sort, slice,
    element_at, collect_set, map_from_entries, concat_ws over arrays."""
    ev = panels.table(spark, d, "events").select(F.col("user_id").cast("string").alias("series_id"), "event_id", "event_type", "value")
    # the three lowest values only are collected, however long a series is
    rank = F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("value").asc_nulls_last(), "event_id"))
    lows = ev.withColumn("rank", rank).filter(F.col("rank") <= 3).groupBy("series_id").agg(F.array_sort(F.collect_list("value")).alias("vs"))
    g = (
        ev.groupBy("series_id")
        .agg(F.collect_set("event_type").alias("types_"), F.min("value").alias("mn"), F.max("value").alias("mx"))
        .join(lows, "series_id")
    )
    low = F.slice("vs", 1, 3)
    m = F.map_from_entries(
        F.array(
            F.struct(F.lit("min").alias("k"), F.col("mn").alias("v")),
            F.struct(F.lit("max").alias("k"), F.col("mx").alias("v")),
        )
    )
    return g.select(
        "series_id",
        F.get(low, F.lit(0)).alias("low1"),
        F.get(low, F.lit(2)).alias("low3"),
        F.col("mx").alias("top"),
        F.size("types_").cast("long").alias("n_types"),
        F.element_at(m, F.lit("max")).alias("map_max"),
        F.concat_ws(",", F.array_sort("types_")).alias("types"),
    )


@register(
    "summary_stats_daily",
    f"SELECT series_id, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, CASE WHEN count(value) >= 3 THEN skewness(value) END AS skew, CASE WHEN count(value) >= 4 THEN kurtosis(value) END AS kurtosis FROM ({S.P3}) _s GROUP BY series_id",
    ["mean", "std", "min", "max", "skew", "kurtosis"],
    bits=10,
)
def q_summary_stats_daily(spark, d):
    """AGG-01 on the daily order-revenue series."""
    return stats.summary_stats(p3(spark, d))


@register("acf_daily", _acf_sql(S.P3, 50), ["acf"])
def q_acf_daily(spark, d):
    """AGG-05 of daily order revenue, lags 0..50."""
    return stats.acf(p3(spark, d), 50)


from pulsegrid import suite_models, suite_streams  # noqa: E402, F401  (they register their queries)
