"""Augmented Dickey-Fuller statistics against least squares in numpy."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest

from barloom.operators.fracdiff import frac_weights, least_stationary_order, stationarity
from barloom.operators.series import time_slices

START = datetime(2025, 1, 1)
GRID = (0.0, 0.4, 1.0)


def series(count, seed):
    chance = np.random.default_rng(seed)
    step = chance.normal(size=count)
    return 100 + np.cumsum(step + 0.6 * np.concatenate([[0], step[:-1]]))


def by_hand(values, d, lags, max_lag):
    weights = frac_weights(d, max_lag=max_lag)
    kernel = np.array(weights + [0.0] * (max_lag + 1 - len(weights)))
    level = np.convolve(values, kernel, "valid")  # from row max_lag on
    change = np.diff(level)
    best = None
    for used in range(lags + 1):
        y = change[lags:]
        x = np.stack(
            [np.ones(len(y)), level[lags : len(level) - 1], *[change[lags - k : len(change) - k] for k in range(1, used + 1)]]
        ).T
        slopes, *_ = np.linalg.lstsq(x, y, rcond=None)
        rest = ((y - x @ slopes) ** 2).sum()
        criterion = len(y) * np.log(rest / len(y)) + 2 * x.shape[1]
        if best is None or criterion < best[0]:
            error = np.sqrt(rest / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
            best = criterion, len(y), used, slopes[1] / error
    return best[1:]


@pytest.mark.parametrize("lags", [0, 1, 4])
@pytest.mark.parametrize("rows", [1 << 20, 37, 300])
def test_statistics(spark, lags, rows):
    values = {"A": series(400, 1), "B": series(150, 2), "short": series(9, 3)}
    frame = spark.createDataFrame(
        [(s, START + timedelta(minutes=k), float(x)) for s, own in values.items() for k, x in enumerate(own)],
        "symbol string, time timestamp_ntz, close double",
    )
    found = stationarity(time_slices(frame, rows=rows).drop("_slice"), GRID, max_lag=20, lags=lags).collect()
    sliced = stationarity(frame, GRID, max_lag=20, lags=lags).collect()
    assert len(found) == len(sliced) == 2 * len(GRID)
    for row in found:
        n, used, statistic = by_hand(values[row.symbol], row.d, lags, 20)
        assert row.n == n and row.t_statistic == pytest.approx(statistic, rel=1e-6)
        assert not lags or row.lags == used


def test_small_slices_give_the_same_sums(spark, monkeypatch):
    """A slice of seven rows gets its history from many slices before it."""
    from barloom.operators import series as cuts

    values = series(300, 4)
    frame = spark.createDataFrame(
        [("A", START + timedelta(minutes=k), float(x)) for k, x in enumerate(values)],
        "symbol string, time timestamp_ntz, close double",
    )
    monkeypatch.setattr(cuts.time_slices, "__defaults__", ("time", None, 7))
    for row in stationarity(frame, GRID, max_lag=20, lags=2).collect():
        n, used, statistic = by_hand(values, row.d, 2, 20)
        assert (row.n, row.lags) == (n, used) and row.t_statistic == pytest.approx(statistic, rel=1e-6)


def test_a_level_series_has_no_statistic(spark):
    frame = spark.createDataFrame(
        [("A", START + timedelta(minutes=k), 5.0) for k in range(60)], "symbol string, time timestamp_ntz, close double"
    )
    assert {r.t_statistic for r in stationarity(frame, (0.0,), max_lag=5, lags=1).collect()} == {None}
    assert least_stationary_order(frame, (0.0, 1.0), max_lag=5, lags=1).first().least_d is None


def test_one_shuffle_of_the_bars(spark):
    frame = spark.createDataFrame([("A", START, 1.0)], "symbol string, time timestamp_ntz, close double")
    plan = stationarity(frame, GRID, lags=2)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(symbol" in line and "_slice" not in line]
    # beyond the slices: the counts of the look-back, and the added sums
    assert all("_kernel" in line or "ENSURE_REQUIREMENTS" in line for line in wide)
