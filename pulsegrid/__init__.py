"""pulsegrid: panel time-series analytics on Spark DataFrames.

Every operator takes and returns DataFrames in the canonical long layout
``(series_id STRING, ts TIMESTAMP_NTZ, seq LONG, value DOUBLE)`` and scales by
``series_id`` (and, for one very long series, by blocks of rows).
"""

from pulsegrid.frame import KEY, ORDER, canonical, series_window  # noqa: F401
from pulsegrid.session import get_session, shared_dir  # noqa: F401

__version__ = "0.1.0"
