import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.schema import BAR  # noqa: E402
from barloom.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_bars(spark):
    """Bars from closes (and optional high, low, volume lists) on consecutive days, or on given days."""

    def make(closes, ticker="AAA", days=None, high=None, low=None, volume=None, start=dt.date(2020, 1, 1)):
        n = len(closes)
        days = days or [start + dt.timedelta(days=i) for i in range(n)]
        high, low = high or closes, low or closes
        volume = volume or [100] * n
        rows = [(ticker, days[i], closes[i], high[i], low[i], closes[i], volume[i]) for i in range(n)]
        return spark.createDataFrame(rows, BAR)

    return make


@pytest.fixture
def small_pieces(monkeypatch):
    """Short segments and blocks, so that small frames cross many borders."""
    from barloom.operators import series

    monkeypatch.setattr(series, "SEGMENT_DAYS", 16)
    monkeypatch.setattr(series, "BLOCK_ROWS", 16)
