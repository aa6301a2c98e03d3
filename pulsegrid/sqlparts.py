"""DuckDB SQL fragments for the oracle side of the query suite.

Each fragment mirrors one Spark operator over the same parquet views. They are
only used to cross-check results; the library itself never parses SQL.
"""

from __future__ import annotations

P1 = "SELECT CAST(user_id AS VARCHAR) AS series_id, ts, event_id AS seq, value FROM events"
P1M = (
    "SELECT CAST(user_id AS VARCHAR) AS series_id, ts, event_id AS seq, "
    "CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events"
)
P2 = """
SELECT sp.series_id, sp.ts, CAST(0 AS BIGINT) AS seq, h.value FROM (
  SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM (
    SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM (
      SELECT event_type AS series_id, date_trunc('hour', ts) AS ts FROM events) GROUP BY series_id)) sp
LEFT JOIN (SELECT event_type AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, avg(value) AS value
           FROM events GROUP BY 1, 2) h
ON sp.series_id = h.series_id AND sp.ts = h.ts
"""
P3 = (
    "SELECT 'orders' AS series_id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS ts, "
    "CAST(0 AS BIGINT) AS seq, sum(o_totalprice) AS value FROM orders GROUP BY 2"
)
P4 = "SELECT 'all' AS series_id, ts, event_id AS seq, value FROM events"

W = "PARTITION BY series_id ORDER BY ts, seq"


def rounded(inner: str, doubles: list[str], bits: int = 20) -> str:
    """Snap the named DOUBLE columns to multiples of 2**-bits like the Spark side
    (and fold -0.0). A binary grid keeps decimal data off the rounding ties."""
    if not doubles:
        return inner
    q = float(2**bits)
    rep = ", ".join(f"round({c} * {q}) / {q} + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) _q"


def with_ord(src: str) -> str:
    return f"SELECT *, row_number() OVER ({W}) - 1 AS ord FROM ({src}) _o"


def with_n(src: str) -> str:
    return f"SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM ({src}) _n"


def iqr_flag(src: str, factor: float = 1.5) -> str:
    return f"""
SELECT p.*, coalesce(p.value < b.q1 - {factor} * (b.q3 - b.q1) OR p.value > b.q3 + {factor} * (b.q3 - b.q1), false) AS outlier
FROM ({src}) p LEFT JOIN (
  SELECT series_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ({src}) GROUP BY 1) b
USING (series_id)"""


def zscore_flag(src: str, threshold: float = 3.0) -> str:
    return f"""
SELECT p.*, coalesce(abs(p.value - b.mu) > {threshold} * b.sd, false) AS outlier
FROM ({src}) p LEFT JOIN (SELECT series_id, avg(value) AS mu, stddev_samp(value) AS sd FROM ({src}) GROUP BY 1) b
USING (series_id)"""


def remove_outliers(src: str, method: str = "iqr") -> str:
    flagged = iqr_flag(src) if method == "iqr" else zscore_flag(src)
    return f"SELECT series_id, ts, seq, CASE WHEN NOT outlier THEN value END AS value FROM ({flagged}) _r"


def fill_cols(src: str) -> str:
    back = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fwd = f"({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    o = "CASE WHEN value IS NOT NULL THEN ord END"
    t = "CASE WHEN value IS NOT NULL THEN epoch_us(ts) END"
    return f"""
SELECT *,
  last_value(value IGNORE NULLS) OVER {back} AS pv,
  last_value({o} IGNORE NULLS) OVER {back} AS po,
  last_value({t} IGNORE NULLS) OVER {back} AS pt,
  first_value(value IGNORE NULLS) OVER {fwd} AS nv,
  first_value({o} IGNORE NULLS) OVER {fwd} AS no,
  first_value({t} IGNORE NULLS) OVER {fwd} AS nt
FROM ({with_ord(src)}) _f"""


def interpolate(src: str, method: str = "linear") -> str:
    f = fill_cols(src)
    if method in ("linear", "time", "index", "values"):
        if method != "linear":
            pos, pp, np_ = "CAST(epoch_us(ts) AS DOUBLE)", "CAST(pt AS DOUBLE)", "CAST(nt AS DOUBLE)"
        else:
            pos, pp, np_ = "CAST(ord AS DOUBLE)", "CAST(po AS DOUBLE)", "CAST(no AS DOUBLE)"
        inner = f"pv + (nv - pv) * (({pos} - {pp}) / nullif({np_} - {pp}, 0))"
        e = (
            f"CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL "
            f"THEN coalesce({inner}, pv) WHEN pv IS NOT NULL THEN pv END"
        )
    elif method == "ffill":
        e = "coalesce(value, pv)"
    elif method == "bfill":
        e = "coalesce(value, nv)"
    else:
        e = (
            "CASE WHEN value IS NOT NULL THEN value WHEN pv IS NOT NULL AND nv IS NOT NULL THEN "
            "CASE WHEN (epoch_us(ts) - pt) <= (nt - epoch_us(ts)) THEN pv ELSE nv END END"
        )
    return f"SELECT series_id, ts, seq, {e} AS value FROM ({f}) _i"


def normalize(src: str, method: str = "zscore") -> str:
    if method == "zscore":
        s = f"SELECT series_id, avg(value) AS a, stddev_samp(value) AS b FROM ({src}) GROUP BY 1"
    elif method == "minmax":
        s = f"SELECT series_id, min(value) AS a, max(value) - min(value) AS b FROM ({src}) GROUP BY 1"
    else:
        s = median_mad(src)
        s = f"SELECT series_id, median AS a, mad AS b FROM ({s}) _m"
    return f"SELECT p.series_id, p.ts, p.seq, (p.value - s.a) / nullif(s.b, 0) AS value FROM ({src}) p LEFT JOIN ({s}) s USING (series_id)"


def median_mad(src: str) -> str:
    return f"""
SELECT p.series_id, any_value(m.median) AS median, quantile_cont(abs(p.value - m.median), 0.5) AS mad
FROM ({src}) p JOIN (SELECT series_id, quantile_cont(value, 0.5) AS median FROM ({src}) GROUP BY 1) m USING (series_id)
GROUP BY p.series_id"""


def rolling_stats(src: str, window: int, warmup: str = "partial") -> str:
    w = f"({W} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    ok = f"count(value) OVER {w} = count(*) OVER {w}"
    if warmup == "full":
        ok += f" AND count(*) OVER {w} = {window}"

    def s(e: str, name: str) -> str:
        return f"CASE WHEN {ok} THEN {e} OVER {w} END AS {name}"

    return f"""
SELECT series_id, ts, seq, {s('avg(value)', 'mean')}, {s('stddev_pop(value)', 'std')},
  {s('min(value)', 'min')}, {s('max(value)', 'max')}, {s('quantile_cont(value, 0.5)', 'median')},
  value AS current, count(*) OVER {w} AS window_size
FROM ({src}) _w"""


ROLLING_DOUBLES = ["mean", "std", "min", "max", "median", "current"]


def full_mean_std(n: int) -> tuple[str, str]:
    w = f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    c = f"count(value) OVER {w} = {n}"
    return (f"CASE WHEN {c} THEN avg(value) OVER {w} END", f"CASE WHEN {c} THEN stddev_samp(value) OVER {w} END")


def features(src: str) -> str:
    cols = []
    for n in (5, 10, 20):
        m, s = full_mean_std(n)
        cols += [f"{m} AS mean{n}", f"{s} AS std{n}"]
    cols += [f"lag(value, {k}) OVER ({W}) AS lag{k}" for k in (1, 2, 3)]
    names = [f"{a}{n}" for n in (5, 10, 20) for a in ("mean", "std")] + ["lag1", "lag2", "lag3"]
    inner = f"SELECT series_id, ts, seq, {', '.join(cols)} FROM ({src}) _a"
    cond = " AND ".join(f"{c} IS NOT NULL" for c in names)
    return f"SELECT * FROM ({inner}) _b WHERE {cond}"


FEATURES = ["mean5", "std5", "mean10", "std10", "mean20", "std20", "lag1", "lag2", "lag3"]
