from __future__ import annotations

import bisect
import random
from datetime import datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from barloom.operators.asof import asof_join
from barloom.operators.series import balanced_slices, time_slices
from barloom.operators.splice import gap_ledger, splice_asof, splice_series
from barloom.sources.layers import stage

START = datetime(2025, 1, 1)


def sides(chance):
    left, right = [], {}
    for symbol in ("A", "B", None, "only left"):
        for _ in range(120):
            left.append((symbol, START + timedelta(seconds=chance.randint(0, 900)), chance.randint(0, 9)))
        for _ in range(25 if symbol != "only left" else 0):
            right[symbol, START + timedelta(seconds=chance.randint(-50, 950))] = chance.randint(100, 999)
    left += left[:5] + [("A", None, 1)]
    right["only right", START] = 5
    return left, right


def found_by_hand(left, right, direction, equal):
    rows = []
    for symbol, time, x in left:
        times = sorted(t for s, t in right if s == symbol)
        if time is None or not times:
            rows.append((symbol, time, x, None))
            continue
        if direction == "backward":
            k = (bisect.bisect_right if equal else bisect.bisect_left)(times, time) - 1
        else:
            k = (bisect.bisect_left if equal else bisect.bisect_right)(times, time)
        rows.append((symbol, time, x, right[symbol, times[k]] if 0 <= k < len(times) else None))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("equal", [True, False])
@pytest.mark.parametrize("rows", [7, 100, 1 << 20])
def test_asof(spark, direction, equal, rows):
    left, right = sides(random.Random(rows))
    bars = spark.createDataFrame(left, "symbol string, time timestamp_ntz, x int")
    marks = spark.createDataFrame([(s, t, v) for (s, t), v in right.items()], "symbol string, time timestamp_ntz, v int")
    slices = partial(time_slices, step_seconds=1.0, rows=rows)
    found = asof_join(bars, marks, ["v"], direction=direction, equal=equal, slices=slices)
    assert found.columns == ["symbol", "time", "x", "v"]
    assert sorted(map(tuple, found.collect()), key=repr) == found_by_hand(left, right, direction, equal)


def test_asof_of_empty_sides(spark):
    bars = spark.createDataFrame([("A", START, 1)], "symbol string, time timestamp_ntz, x int")
    marks = bars.withColumnRenamed("x", "v")
    assert [r.v for r in asof_join(bars, marks.limit(0), ["v"]).collect()] == [None]
    assert asof_join(bars.limit(0), marks, ["v"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(bars, marks, ["v"], direction="nearest")


def rolled(spark, bars=200):
    chance = random.Random(3)
    rows = [
        (symbol, START + timedelta(minutes=k), f"C{k // (30 if symbol == 'A' else 70)}", *[chance.random() * 50] * 4)
        for symbol in ("A", "B") for k in range(bars)
    ]
    names = "symbol string, time timestamp_ntz, original_contract string, open double, high double, low double, close double"
    return spark.createDataFrame(rows, names)


def test_a_ledger_splices_like_the_running_sum(spark):
    frame = rolled(spark)
    ledger = gap_ledger(frame, roots=None)
    assert ledger.count() == 6 + 2
    names = ["symbol", "time", *[F.round(n, 6).alias(n) for n in ("open", "high", "low", "close")]]
    for slices in (time_slices, partial(time_slices, rows=11), partial(balanced_slices, limit=50)):
        found = splice_asof(stage(frame, "bars"), ledger, slices=slices).select(*names)
        expected = splice_series(frame, roots=None).select(*names)
        assert sorted(found.collect()) == sorted(expected.collect())


def test_no_range_in_the_joins(spark):
    frame = rolled(spark, 20)
    plan = splice_asof(frame, gap_ledger(frame, roots=None))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("NestedLoop" in line or "Cartesian" in line or "<" in line.split("Join", 1)[1] for line in joins)


def test_a_further_roll_changes_the_ledger_only(spark):
    frame = rolled(spark)
    before = frame.where("time < timestamp_ntz'2025-01-01 02:00:00'")
    old, new = (gap_ledger(x, roots=None) for x in (before, frame))
    count = {name: x.where("symbol = 'A'").count() for name, x in (("old", old), ("new", new))}
    assert count == {"old": 3, "new": 6}
    found = splice_asof(before, new).groupBy("symbol").agg(F.count("*")).collect()
    assert len(found) == 2
