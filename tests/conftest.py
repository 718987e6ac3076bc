import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockwave.session import build_session, drop_staged  # noqa: E402
from stockwave.sources.schemas import PANEL_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("stockwave-tests", cores="8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def panel(spark):
    """A small panel with gaps in dates, a one-row category and null exogenous values."""
    start = dt.date(2020, 1, 1)
    rows = []
    for i in range(80):
        day = start + dt.timedelta(days=i)
        if i % 9 != 4:
            price = None if i < 3 or i % 11 == 5 else 10.0 + i % 7
            rows.append((day, "toys", 5 + (i * 7) % 13, price, 100.0 + i, 2.5, None if i % 4 else 4.0, 1.5))
        if i % 3:
            rows.append((day, "books", 1 + (i * 5) % 6, 20.0 + i % 5, 50.0 + i, 1.5, 3.5, 2.0))
    rows.append((start + dt.timedelta(days=40), "single", 3, 9.0, 27.0, 1.0, 5.0, 1.0))
    return spark.createDataFrame(rows, PANEL_SCHEMA).cache()
