"""Bars from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.times import micros, truncated


def arrival_order(time: str, sequence: str) -> Column:
    """Time, then sequence, as one decimal.

    A decimal buffer keeps ``min_by`` in hash aggregation, where a struct would
    sort all rows before the map-side combine. The factor exceeds twice the
    largest bigint, so the sequence never reaches into the time.
    """
    at = micros(F.col(time)).cast("decimal(18,0)")
    factor = F.lit("20000000000000000000").cast("decimal(20,0)")
    return at * factor + F.col(sequence).cast("decimal(19,0)")


def ohlc_aggregates(value: str, order: Column) -> list[Column]:
    return [
        F.min_by(value, order).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, order).alias("close"),
        F.count("*").alias("tick_volume"),
    ]


def ohlc_bars(
    events: DataFrame,
    unit: str = "hour",
    symbol: str = "event_type",
    time: str = "ts",
    value: str = "value",
    sequence: str = "event_id",
) -> DataFrame:
    """One bar per symbol and time unit; combined before the only shuffle."""
    return events.groupBy(
        F.col(symbol).alias("symbol"), truncated(F.col(time), unit).alias("time")
    ).agg(*ohlc_aggregates(value, arrival_order(time, sequence)))
