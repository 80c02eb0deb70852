from __future__ import annotations

import logging

import pytest
from pyspark.sql import functions as F

from barloom.functions.checks import is_degraded, is_finite, is_spike, violates_ohlcv
from barloom.operators.quality import (
    DataQualityError,
    quality_report,
    require_valid,
    samples,
    validate,
)

SCHEMA = "time string, open double, high double, low double, close double, tick_volume bigint"
GOOD = [
    ("2026-08-19", 100.0, 110.0, 90.0, 105.0, 1000),
    ("2026-08-20", 105.0, 115.0, 100.0, 110.0, 1500),
]


def test_valid_bars_pass_unchanged(spark):
    df = spark.createDataFrame(GOOD, SCHEMA)
    passed = require_valid(df)
    assert (passed.count(), len(passed.columns)) == (2, 6)


@pytest.mark.parametrize(
    "bar",
    [
        ("2026-08-19", 100.0, 80.0, 90.0, 105.0, 1000),
        ("2026-08-19", 100.0, 110.0, 90.0, None, 1000),
        ("2026-08-19", None, 110.0, 90.0, 100.0, 1000),
        ("2026-08-19", 111.0, 110.0, 90.0, 100.0, 1000),
        ("2026-08-19", 100.0, 110.0, 90.0, 111.0, 1000),
        ("2026-08-19", 89.0, 110.0, 90.0, 100.0, 1000),
        ("2026-08-19", 100.0, 110.0, 90.0, 89.0, 1000),
        ("2026-08-19", 100.0, 110.0, 90.0, 100.0, -1),
    ],
)
def test_bad_bar_raises(spark, bar):
    df = spark.createDataFrame([bar, GOOD[1]], SCHEMA)
    with pytest.raises(DataQualityError, match="price integrity check failed for 1 bars"):
        require_valid(df)
    good, bad, _ = validate(df.withColumn("symbol", F.lit("A")))
    assert [r["time"] for r in good.collect()] == ["2026-08-20"]
    assert [r["time"] for r in bad.collect()] == ["2026-08-19"]


def test_null_high_low_and_volume_pass_the_gate(spark):
    df = spark.createDataFrame([("t", 100.0, None, None, 100.0, None)], SCHEMA)
    assert require_valid(df).count() == 1


def test_spike_only_warns(spark, caplog):
    df = spark.createDataFrame([("2026-08-19", 100.0, 150.0, 90.0, 140.0, 1000)], SCHEMA)
    with caplog.at_level(logging.WARNING):
        assert require_valid(df).count() == 1
    assert "move more than 20%" in caplog.text


@pytest.mark.parametrize(
    "open_, high, low, expected",
    [
        (100.0, 120.0, 100.0, False),
        (100.0, 120.1, 100.0, True),
        (0.0, 1.0, 0.0, True),
        (0.0, 0.0, 0.0, False),
        (None, 1.0, 0.0, False),
    ],
)
def test_spike_rule(spark, open_, high, low, expected):
    df = spark.createDataFrame([(open_, high, low)], "open double, high double, low double")
    assert df.select(is_spike()).first()[0] is expected


def test_report_by_series(spark):
    rows = [("A", *GOOD[0]), ("A", "x", 1.0, 0.0, 2.0, 1.0, 1), ("B", *GOOD[1])]
    report = quality_report(spark.createDataFrame(rows, f"symbol string, {SCHEMA}"))
    found = {r["symbol"]: (r["is_valid"], r["validated_rows"], r["violations"]) for r in report.collect()}
    assert found == {"A": (False, 2, 1), "B": (True, 1, 0)}


def test_five_samples_in_time_order(spark):
    rows = [("A", f"{i:02d}", 1.0, 0.0, 2.0, 1.0, 1) for i in range(9, -1, -1)]
    df = spark.createDataFrame(rows, f"symbol string, {SCHEMA}")
    shown = samples(df, violates_ohlcv()).orderBy("sample").collect()
    assert [r["time"] for r in shown] == ["00", "01", "02", "03", "04"]


def test_finite_rows(spark):
    values = [(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    df = spark.createDataFrame(values, "close double")
    assert [r["close"] for r in df.where(is_finite(df)).collect()] == [1.0, None]


@pytest.mark.parametrize("sharpe, expected", [(None, True), (1.2, True), (1.5, False), (2.0, False)])
def test_degraded_model(spark, sharpe, expected):
    df = spark.createDataFrame([(sharpe,)], "s double")
    assert df.select(is_degraded(F.col("s"))).first()[0] is expected
