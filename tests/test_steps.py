from datetime import datetime, timedelta

import pandas as pd
import pytest

from conftest import frame
from pulsegrid.operators import forecast
from pulsegrid.sources.spine import fill_on_spine, time_spine
from pulsegrid.sources.steps import Step, next_stamps, step_of, time_steps


def _frame(spark, stamps, sid="s"):
    return frame(spark, [(sid, pd.Timestamp(t).to_pydatetime(), 0, float(i)) for i, t in enumerate(stamps)])


def test_steps_by_name():
    assert step_of("2 hours") == Step(7_200_000_000) and step_of("1 quarter") == Step(None, 3) and step_of("1 month end") == Step(None, 1, True)
    for bad in ("0 hours", "1 fortnight", "1 day end", "month"):
        with pytest.raises(ValueError):
            step_of(bad)


@pytest.mark.parametrize("every,offset,first", [("1 month", pd.DateOffset(months=1), "2023-01-31 06:30"), ("1 quarter", pd.DateOffset(months=3), "2023-02-28"), ("1 year", pd.DateOffset(years=1), "2024-02-29"), ("2 weeks", pd.Timedelta(weeks=2), "2023-01-01")])
def test_grid_counts_from_its_first_point(spark, every, offset, first):
    lo = pd.Timestamp(first)
    want = [lo + offset * k for k in range(9)]
    got = [r.ts for r in time_spine(_frame(spark, [lo, want[-1] + pd.Timedelta(hours=5)]), every).orderBy("ts").collect()]
    assert got == [t.to_pydatetime() for t in want]
    # just before the last point it does not belong to the grid
    short = time_spine(_frame(spark, [lo, want[-1] - pd.Timedelta(microseconds=1)]), every)
    assert short.count() == 8


def test_month_end_grid_and_filling(spark):
    days = pd.date_range("2023-01-10", "2023-06-29", freq="D")
    got = [(r.ts, r.value) for r in fill_on_spine(_frame(spark, days), "1 month end").orderBy("ts").collect()]
    ends = [datetime(2023, 1, 31), datetime(2023, 2, 28), datetime(2023, 3, 31), datetime(2023, 4, 30), datetime(2023, 5, 31)]
    assert [t for t, _ in got] == ends
    s = pd.Series(range(len(days)), days, dtype=float)
    # rows before the first point count for it
    assert [v for _, v in got] == [s[(s.index >= (a if k else days[0])) & (s.index < b)].mean() for k, (a, b) in enumerate(zip(ends, [*ends[1:], datetime(2030, 1, 1)]))]


def test_inferred_steps(spark):
    series = {
        "monthly": pd.date_range("2022-03-15 08:00", periods=20, freq=pd.DateOffset(months=1)),
        "ends": pd.date_range("2022-01-31", periods=20, freq="ME"),
        "quarters": pd.date_range("2020-01-01", periods=9, freq="QS"),
        "yearly": pd.date_range("2010-02-28", periods=9, freq=pd.DateOffset(years=1)),
        "daily": pd.date_range("2022-01-01", periods=90, freq="D"),
        "gapped": pd.date_range("2022-01-01", periods=24, freq="MS").delete([3, 9, 10]),
        "hourly": pd.date_range("2022-01-31 22:00", periods=30, freq="h"),
        "one": pd.date_range("2022-01-01", periods=1),
    }
    df = None
    for sid, stamps in series.items():
        part = _frame(spark, stamps, sid)
        df = part if df is None else df.unionByName(part)
    got = {r.series_id: r for r in time_steps(df).collect()}
    months = {k: (r.gap_months, r.month_end) for k, r in got.items()}
    assert months == {"monthly": (1, False), "ends": (1, True), "quarters": (3, False), "yearly": (12, False), "daily": (None, False), "gapped": (1, False), "hourly": (None, False), "one": (None, False)} | {"yearly": (12, months["yearly"][1])}
    assert got["daily"].gap_us == 86_400_000_000 and got["hourly"].gap_us == 3_600_000_000 and got["one"].gap_us is None
    for sid in ("monthly", "ends", "quarters"):
        stamps = series[sid]
        r = got[sid]
        assert next_stamps(stamps[7], r.gap_us, r.gap_months, r.month_end, 12) == list(stamps[8:20])[:12] + ([] if len(stamps) >= 20 else next_stamps(stamps[7], r.gap_us, r.gap_months, r.month_end, 12)[len(stamps) - 8 :])


def test_forecasts_lie_on_the_calendar(spark):
    stamps = pd.date_range("2019-01-31", periods=60, freq="ME")
    df = _frame(spark, stamps)
    want = [t.to_pydatetime() for t in pd.date_range(stamps[-1], periods=14, freq="ME")[1:]]
    f = forecast.arima_forecast(forecast.arima_fit(df, (1, 1, 0), auto_stationary=False), 13).orderBy("step").collect()
    assert [r.ts for r in f] == want
    t = forecast.trend_season_forecast(forecast.trend_season_fit(df, weekly=False, daily=False, yearly=False, changepoints=2), 13, history=df).orderBy("step").collect()
    assert [r.ts for r in t] == want and t[0].forecast == pytest.approx(60, abs=0.5)


def test_a_series_shorter_than_its_design_fails(spark):
    rows = [("two", datetime(2023, 1, 1) + timedelta(hours=i), i, float(i)) for i in range(2)]
    rows += [("more", datetime(2023, 1, 1) + timedelta(hours=i), i, float(i % 5)) for i in range(200)]
    got = {r.series_id: r.status for r in forecast.trend_season_fit(frame(spark, rows)).collect()}
    assert got == {"two": "failed", "more": "ok"}
