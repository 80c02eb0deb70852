from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "lake")


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def bar_rows(count: int, symbol: str = "TEST$", start: int = 0) -> list[dict]:
    """Minute bars of a rising series; the range widens by the minute."""
    rows = []
    for i in range(start, start + count):
        first = 20.0 + i / 4
        rows.append(
            {
                "symbol": symbol,
                "time": (datetime(2025, 3, 3, 10) + timedelta(minutes=i)).isoformat(" "),
                "close": first + 0.5,
                "low": first - 0.25 - i / 100,
                "high": first + 0.75 + i / 100,
                "open": first,
                "tick_volume": 40 + i * i % 7,
            }
        )
    return rows


def many_bars(spark, symbols: list[str], bars: int):
    """A frame of bars of several symbols."""
    return spark.createDataFrame(pd.DataFrame([r for s in symbols for r in bar_rows(bars, s)]))
