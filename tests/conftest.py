import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "riskmart-tests",
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples; None sorts first."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: [(v is not None, v) for v in t])
