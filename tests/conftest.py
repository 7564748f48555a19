import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sentrylake import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


EVENT_SCHEMA = (
    "event_id string, ts timestamp, ts_ms bigint, event_type string, source_ip string, destination_ip string, "
    "user string, status string, threat_score double, geo_location string"
)


def make_event(i, user="alice", hour=10, ip="10.20.0.7", kind="auth_attempt", status="success", geo="harbour", score=0.1):
    """The i-th event: one per day, at the given hour."""
    ts = dt.datetime(2024, 1, 1, hour, tzinfo=dt.timezone.utc) + dt.timedelta(days=i)
    ms = int(ts.timestamp() * 1000)
    return (f"evt_{user:0>4.4}{i:08d}", ts, ms, kind, ip, None, user, status, score, geo)


@pytest.fixture(scope="session")
def events_of(spark):
    return lambda rows: spark.createDataFrame(rows, EVENT_SCHEMA)
