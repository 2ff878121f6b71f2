import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from trailmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    """Events from (visitorid, 'YYYY-mm-dd HH:MM:SS', event, itemid) tuples."""

    def build(rows):
        df = spark.createDataFrame(rows, "visitorid bigint, timestamp string, event string, itemid bigint")
        return df.selectExpr("visitorid", "cast(timestamp as timestamp) as timestamp", "event", "itemid")

    return build


@pytest.fixture(scope="session")
def properties(spark):
    def build(rows):
        df = spark.createDataFrame(rows, "timestamp string, itemid bigint, property string, value double")
        return df.selectExpr("cast(timestamp as timestamp) as timestamp", "itemid", "property", "value")

    return build
