"""The perpetual series of overlapping contracts."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators.chain import contract_calendar, perpetual_chain

BARS = (
    "root string, contract string, time timestamp_ntz, open double, high double, low double, close double,"
    " tick_volume bigint, open_interest bigint"
)


def day(number, month=1):
    return datetime(2026, month, number)


def calendar(spark, *codes):
    return contract_calendar(spark.createDataFrame([(c,) for c in codes], "contract string"))


def bars(spark, rows):
    return spark.createDataFrame(
        [(c[:3], c, t, p, p + 1, p - 1, p, v, i) for c, t, p, v, i in rows], BARS
    )


def test_calendar(spark):
    found = calendar(spark, "WDOG26", "WDOH26", "WDOF26", "WINJ26", "WING26", "WINH26", "odd", "WDOG26").collect()
    assert {(r.contract, r.following, str(r.time)[:10]) for r in found} == {
        ("WDOF26", "WDOG26", "2026-01-01"), ("WDOG26", "WDOH26", "2026-02-02"), ("WDOH26", None, "2026-03-02"),
        ("WING26", "WINJ26", "2026-02-18"), ("WINJ26", None, "2026-04-15"),
    }


def test_the_roll_does_not_flip_back(spark):
    rows = []
    for number, (a, b) in enumerate([(90, 10), (60, 40), (30, 70), (80, 20), (10, 90)], 5):
        rows += [("WDOG26", day(number), 100.0, a, 0), ("WDOH26", day(number), 110.0, b, 0), ("WDOJ26", day(number), 1.0, 999, 0)]
    found = perpetual_chain(bars(spark, rows), calendar(spark, "WDOG26", "WDOH26", "WDOJ26")).orderBy("time").collect()
    assert [(r.front, r.following) for r in found] == [("WDOG26", "WDOH26")] * 5
    assert [r.front_weight for r in found] == pytest.approx([0.9, 0.6, 0.3, 0.3, 0.1])
    assert [r.rolled for r in found] == [False, False, True, True, True]
    assert [r.close for r in found] == pytest.approx([101.0, 104.0, 107.0, 107.0, 109.0])
    assert {r.tick_volume for r in found} == {100}


def test_fronts_change_at_expiry_and_begin_anew(spark):
    rows = [
        ("WDOG26", day(2, 2), 100.0, 10, 0), ("WDOH26", day(2, 2), 110.0, 90, 0),
        ("WDOG26", day(3, 2), 5.0, 50, 0), ("WDOH26", day(3, 2), 111.0, 90, 0), ("WDOJ26", day(3, 2), 120.0, 30, 0),
    ]
    first, second = perpetual_chain(bars(spark, rows), calendar(spark, "WDOG26", "WDOH26", "WDOJ26")).orderBy("time").collect()
    assert (first.front, first.rolled, first.close) == ("WDOG26", True, pytest.approx(109.0))
    assert (second.front, second.rolled, second.close) == ("WDOH26", False, pytest.approx(0.75 * 111 + 0.25 * 120))


def test_open_interest_and_lone_bars(spark):
    rows = [
        ("WDOG26", day(5), 100.0, 10, 30), ("WDOH26", day(5), 110.0, 10, 0),
        ("WDOG26", day(6), 100.0, 10, None), ("WDOH26", day(7), 110.0, 10, 5),
        ("WDOG26", day(4), 100.0, 0, 0), ("WDOH26", day(4), 110.0, None, 0),
    ]
    names = calendar(spark, "WDOG26", "WDOH26")
    found = {r.time.day: r for r in perpetual_chain(bars(spark, rows), names).collect()}
    assert found[4].front_weight == 1.0 and found[4].close == 100.0
    assert found[5].front_weight == pytest.approx(0.8)
    assert (found[6].front_weight, found[6].close) == (1.0, 100.0)
    assert (found[7].front_weight, found[7].close, found[7].rolled) == (0.0, 110.0, True)
    bare = bars(spark, rows).drop("open_interest")
    assert perpetual_chain(bare, names).where(F.dayofmonth("time") == 5).first().front_weight == pytest.approx(0.5)
    assert perpetual_chain(bare.limit(0), names).count() == 0
