import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pulsegrid.session import get_session

    s = get_session("*", shuffle_partitions=8, app="pulsegrid-tests")
    yield s
    s.stop()


def rows(df, cols=None, digits=9):
    """Order-insensitive comparable rows with rounded floats."""
    cols = cols or sorted(df.columns)
    out = []
    for r in df.select(*cols).collect():
        t = []
        for v in r:
            if isinstance(v, float):
                v = None if v != v else round(v, digits) + 0.0
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=repr)


def frame(spark, data, schema="series_id string, ts timestamp_ntz, seq long, value double"):
    return spark.createDataFrame(data, schema)
