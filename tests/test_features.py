from __future__ import annotations

import math
import statistics

import pytest
from conftest import bar_rows
from pyspark.sql import functions as F

from barloom.operators.features import percent_return, technical_features
from barloom.operators.series import balanced_slices
from barloom.plans.silver import clean_bars
from barloom.schemas import FEATURES


@pytest.fixture(scope="module")
def bars(spark):
    rows = bar_rows(25, "A") + bar_rows(12, "B", start=30) + bar_rows(10, "C")
    return clean_bars(rows)


def test_first_ten_rows_of_each_series_go(bars):
    counts = technical_features(bars).groupBy("symbol").count().collect()
    assert {r["symbol"]: r["count"] for r in counts} == {"A": 15, "B": 2}


def test_values_by_hand(bars):
    first = technical_features(bars).where(F.col("symbol") == "A").orderBy("time").first()
    days = bar_rows(11)
    closes, volumes = [d["close"] for d in days], [d["tick_volume"] for d in days]
    last = days[-1]
    returns = [math.log(b) - math.log(a) for a, b in zip(closes, closes[1:])]
    high_low, close_open = math.log(last["high"] / last["low"]), math.log(last["close"] / last["open"])
    span, mean = last["high"] - last["low"], statistics.fmean(volumes[1:])
    assert first["log_return"] == pytest.approx(returns[-1])
    assert first["realized_volatility"] == pytest.approx(statistics.stdev(returns))
    assert first["garman_klass_volatility"] == pytest.approx(
        math.sqrt(0.511 * high_low**2 - 0.3862943611198906 * close_open**2)
    )
    assert first["parkinson_volatility"] == pytest.approx(high_low / math.sqrt(4 * math.log(2)))
    assert first["order_flow_imbalance"] == pytest.approx(0.5 / (span + 1e-6) * volumes[-1])
    assert first["volume_momentum"] == pytest.approx(volumes[-1] / (mean + 1e-6))
    assert first["frac_diff_proxy"] == pytest.approx(
        closes[-1] - 0.4 * closes[-2] - 0.12 * closes[-3]
    )
    assert first["minute_sin"] == pytest.approx(math.sin(2 * math.pi * 10 / 60))


def test_short_slices_change_nothing(bars):
    whole = technical_features(bars).orderBy("symbol", "time").collect()
    sliced = technical_features(balanced_slices(bars, limit=3)).orderBy("symbol", "time").collect()
    assert len(whole) == len(sliced) == 17
    for a, b in zip(whole, sliced):
        assert [a[n] for n in FEATURES] == pytest.approx([b[n] for n in FEATURES])


def test_prices_of_zero_give_no_feature_row(bars):
    zero = bars.withColumn("low", F.when(F.minute("time") == 20, 0.0).otherwise(F.col("low")))
    rows = technical_features(zero).where(F.col("symbol") == "A")
    assert rows.count() == 14


def test_percent_return(bars):
    second = percent_return(bars).where("symbol = 'A'").orderBy("time").collect()[1]
    assert second["percent_return"] == pytest.approx(0.25 / 20.5)


def test_frame_without_time_gives_none(spark):
    assert technical_features(spark.range(3)).count() == 0
