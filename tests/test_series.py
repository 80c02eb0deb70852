"""Sliced windows against plain windows over whole series."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators.fracdiff import frac_weights, fractional_difference
from barloom.operators.series import (
    COPIED,
    SLICE,
    balanced_slices,
    over_series,
    time_slices,
    with_lookback,
)

START = datetime(2026, 1, 1)


def uneven(count: int, seed: int) -> list[tuple]:
    """Bursts and long gaps; one series owns most rows, one has a single row."""
    chance = random.Random(seed)
    rows, moment = [("lone", START, 1.0)], START
    for _ in range(count):
        moment += timedelta(seconds=chance.choice([1, 1, 1, 60, 3600, 86400]))
        rows.append(("hot" if chance.random() < 0.7 else "cold", moment, chance.uniform(90, 110)))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        uneven(600, 7), "symbol string, time timestamp_ntz, close double"
    ).repartition(5)


def plain_lags(df, lag):
    window = Window.partitionBy("symbol").orderBy("time")
    return df.select("symbol", "time", F.lag("close", lag).over(window).alias("before"))


def sliced_lags(df, lag):
    built = over_series(
        df, lag, lambda s, w: s.withColumn("before", F.lag("close", lag).over(w)), keys=["symbol"]
    )
    return built.select("symbol", "time", "before")


@pytest.mark.parametrize("lag", [1, 3, 25])
@pytest.mark.parametrize("seconds", [1, 600, 86400, 10**8])
def test_lag_sees_rows_of_earlier_slices(frame, lag, seconds):
    sliced = sliced_lags(time_slices(frame, step_seconds=seconds, rows=1), lag)
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain_lags(frame, lag).collect()))


@pytest.mark.parametrize("partitions, target", [(3, "64m"), (40, "1k")])
def test_result_does_not_depend_on_partitioning(spark, frame, partitions, target):
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        sliced = sliced_lags(time_slices(frame, step_seconds=3600, rows=1), 10).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(map(str, sliced)) == sorted(map(str, plain_lags(frame, 10).collect()))


def test_copies_are_the_rows_before_the_slice(frame):
    sliced = time_slices(frame, step_seconds=86400, rows=1)
    full = with_lookback(sliced, 5, ["symbol"])
    per_slice = full.groupBy("symbol", SLICE).agg(
        F.max(F.when(F.col(COPIED), F.col("time"))).alias("newest_copy"),
        F.min(F.when(~F.col(COPIED), F.col("time"))).alias("oldest_row"),
        F.count_if(F.col(COPIED)).alias("copies"),
    )
    assert per_slice.where(F.col("newest_copy") >= F.col("oldest_row")).count() == 0
    assert per_slice.agg(F.max("copies")).first()[0] == 5
    assert full.where(~F.col(COPIED)).count() == frame.count()


@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_balanced_slices_hold_the_limit(frame, limit):
    sliced = balanced_slices(frame, keys=["symbol"], limit=limit)
    sizes = sliced.groupBy("symbol", SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= limit
    assert sliced.count() == frame.count()
    # slices follow one another in time
    spans = sliced.groupBy("symbol", SLICE).agg(F.min("time").alias("a"), F.max("time").alias("b"))
    newer = Window.partitionBy("symbol").orderBy(SLICE)
    overlaps = spans.withColumn("next", F.lead("a").over(newer)).where(F.col("next") <= F.col("b"))
    assert overlaps.count() == 0


def test_slice_width_follows_the_timeframe(spark):
    rows = [(label, START) for label in ("M1", "M5", "H4", "D1", "MN1", "ticks", None)]
    df = time_slices(spark.createDataFrame(rows, "timeframe string, time timestamp_ntz"), rows=10)
    starts = {r["timeframe"]: r[SLICE] for r in df.collect()}
    micros = int((START - datetime(1970, 1, 1)).total_seconds()) * 10**6
    steps = {"M1": 60, "M5": 300, "H4": 14400, "D1": 86400, "MN1": 2592000, None: 60}
    steps["ticks"] = 0.1
    for label, seconds in steps.items():
        width = int(seconds * 10 * 10**6)
        assert starts[label] == micros - micros % width


def test_hot_series_spreads_over_tasks(spark):
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"), F.lit(0))
    hot = spark.range(20_000).select(
        F.lit("hot").alias("symbol"),
        (F.lit(START).cast("timestamp_ntz") + minutes).alias("time"),
        F.rand(1).alias("close"),
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        placed = sliced_lags(balanced_slices(hot, keys=["symbol"], limit=500), 10).withColumn(
            "task", F.spark_partition_id()
        )
        loads = [r["count"] for r in placed.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(loads) == 4
    assert max(loads) < 10_000


def brute_force(values, weights):
    return [
        sum(w * values[i - k] for k, w in enumerate(weights) if i >= k) for i in range(len(values))
    ]


def test_weights():
    weights = frac_weights(0.4)
    assert len(weights) == 101
    assert weights[:3] == pytest.approx([1.0, -0.4, -0.12])
    assert weights[-1] == pytest.approx(-4.27e-4, rel=1e-2)
    assert frac_weights(1.0) == [1.0, -1.0]
    assert frac_weights(0.0) == [1.0]
    assert len(frac_weights(0.4, threshold=0.01)) < 101


def test_fractional_difference_of_three_rows(spark):
    rows = [("A", "2026-08-19", 100.0), ("A", "2026-08-20", 102.0), ("A", "2026-08-21", 105.0)]
    df = spark.createDataFrame(rows, "symbol string, day string, close double").select(
        "symbol", F.col("day").cast("timestamp_ntz").alias("time"), "close"
    )
    found = [r["frac_diff_close"] for r in fractional_difference(df).orderBy("time").collect()]
    assert found == pytest.approx([100.0, 62.0, 52.2])
    late = fractional_difference(df, warmup="null").collect()
    assert {r["frac_diff_close"] for r in late} == {None}


@pytest.mark.parametrize("limit", [9, 150, 100_000])
def test_fractional_difference_matches_brute_force(frame, limit):
    holed = frame.withColumn("close", F.when(F.second("time") != 7, F.col("close")))
    sliced = balanced_slices(holed, keys=["symbol"], limit=limit)
    found = fractional_difference(sliced).collect()
    weights = frac_weights(0.4)
    for symbol in ("hot", "cold", "lone"):
        rows = sorted((r for r in found if r["symbol"] == symbol), key=lambda r: r["time"])
        expected = brute_force([r["close"] or 0.0 for r in rows], weights)
        assert np.allclose([r["frac_diff_close"] for r in rows], expected)


def test_batches_carry_history(spark, frame):
    def values():
        rows = fractional_difference(frame).orderBy("symbol", "time").collect()
        return [r["frac_diff_close"] for r in rows]

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    whole = values()
    try:
        spark.conf.set(name, "17")
        assert np.allclose(values(), whole)
    finally:
        spark.conf.set(name, before)
