import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[*]", 8, app_name="tidemark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def interaction_schema():
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("action_type", T.StringType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("app_version", T.StringType()),
    ])


@pytest.fixture
def make_events(spark, interaction_schema):
    """Rows of (user, 'YYYY-mm-dd HH:MM:SS[.ffffff]') -> interactions frame."""
    import datetime as dt

    def _make(rows, action="view", duration=100):
        out = []
        for r in rows:
            user, ts = r[0], r[1]
            t = dt.datetime.fromisoformat(ts) if isinstance(ts, str) else ts
            dur = r[2] if len(r) > 2 else duration
            out.append((user, t, action, "p1", dur, "1.0.0"))
        return spark.createDataFrame(out, interaction_schema)
    return _make
