"""Boolean column expressions: bar integrity, spikes, finite values, model drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import constants as C


def violates_ohlcv() -> Column:
    """True, false or null; only true marks a bad bar."""
    open_, high, low, close = (F.col(name) for name in ("open", "high", "low", "close"))
    return (
        (high < low)
        | (high < open_)
        | (high < close)
        | (low > open_)
        | (low > close)
        | (F.col("tick_volume") < 0)
        | open_.isNull()
        | close.isNull()
    )


def is_spike() -> Column:
    """The range exceeds a fifth of the opening price; never null."""
    span = F.col("high") - F.col("low")
    return F.coalesce(
        F.try_divide(span, F.col("open")) > F.lit(C.SPIKE_RANGE),
        (F.col("open") == 0) & (span > 0),
        F.lit(False),
    )


def is_finite(df: DataFrame) -> Column:
    """No infinite or not-a-number value in any floating-point column; nulls pass."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    tests = [
        F.col(c).isNull() | ~(F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf"))))
        for c in floating
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def is_degraded(sharpe: Column, least: float = C.MIN_SHARPE) -> Column:
    """A model without a Sharpe ratio counts as one with ratio zero."""
    return F.coalesce(sharpe, F.lit(0.0)) < F.lit(least)
