"""Features of a stream of bars against the batch form."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators.features import technical_features
from barloom.operators.fracdiff import fractional_difference
from barloom.streaming.features import store_features, stored_features, stream_features

START = datetime(2025, 1, 1)
SCHEMA = "symbol string, time timestamp_ntz, open double, high double, low double, close double, tick_volume bigint"


def bar(symbol, minute):
    chance = random.Random(f"{symbol}{minute}")
    low, high = sorted(10 + 5 * chance.random() for _ in range(2))
    return (symbol, START + timedelta(minutes=minute), low, high, low, high, chance.randint(1, 50))


def run(spark, folder, batches, delay="10 minutes", rounds=1):
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/arriving")
        if rounds > 1 or number == len(batches) - 1:
            arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arriving")
            found = stream_features(arriving, delay)
            store_features(found, f"{folder}/out", f"{folder}/checkpoint", availableNow=True).awaitTermination()
    return stored_features(spark, f"{folder}/out")


def rows_of(frame):
    numbers = {f.name: F.round(f.name, 8) for f in frame.schema if f.dataType.typeName() == "double"}
    return sorted(map(repr, frame.withColumns(numbers).select(sorted(frame.columns)).collect()))


def batch_form(spark, rows):
    frame = fractional_difference(spark.createDataFrame(rows, SCHEMA))
    return technical_features(frame)


@pytest.mark.parametrize("rounds", [1, 2])
def test_bars_out_of_order(spark, tmp_path, rounds):
    """Within the delay any order will do; a series that ends is let go by the timer."""
    rows = [bar("A", k) for k in range(260)] + [bar("B", k) for k in range(60)]
    mixed = sorted(rows, key=lambda row: (row[1] - START).total_seconds() // 60 + random.Random(repr(row)).randint(0, 9))
    batches = [mixed[k : k + 64] for k in range(0, len(mixed), 64)]
    found = run(spark, str(tmp_path), batches, rounds=rounds)
    last = max(row[1] for row in rows) - timedelta(minutes=10)
    expected = batch_form(spark, rows).where(F.col("time") <= F.lit(last))
    assert rows_of(found) == rows_of(expected)


def test_late_bars_are_left_out(spark, tmp_path):
    rows = [bar("A", k) for k in range(100) if k != 30]
    late = [bar("A", 30), bar("A", 100)]
    found = run(spark, str(tmp_path), [rows[:60], rows[60:], late, [bar("A", 200)]])
    expected = batch_form(spark, [*rows, bar("A", 100)])
    assert rows_of(found) == rows_of(expected)


def test_odd_values(spark, tmp_path):
    rows = [list(bar("A", k)) for k in range(80)]
    rows[20][5] = 0.0
    rows[40][6] = None
    rows[60][5] = None
    rows = [tuple(row) for row in rows]
    found = run(spark, str(tmp_path), [rows, [bar("A", 500)]])
    assert rows_of(found) == rows_of(batch_form(spark, rows))


def test_short_series_has_no_features(spark, tmp_path):
    found = run(spark, str(tmp_path), [[bar("A", k) for k in range(9)], [bar("B", 900)]])
    assert found.count() == 0


def test_tail_is_long_enough():
    from barloom.operators.fracdiff import frac_weights
    from barloom.streaming.features import TAIL, ordered_features

    weights = np.array(frac_weights(0.4))
    rows = np.abs(np.random.default_rng(1).normal(50, 3, size=(400, 6)))
    whole = ordered_features(rows, weights)
    part = ordered_features(rows[300 - TAIL :], weights)
    assert np.allclose(whole[300:], part[TAIL:], rtol=1e-12)
