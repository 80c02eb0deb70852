from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F

from barloom.operators.series import balanced_slices
from barloom.operators.splice import perpetual_roll, splice_broadcast, splice_series
from barloom.plans.silver import clean_bars

FORMS = [splice_series, splice_broadcast]
SCHEMA = (
    "symbol string, time timestamp_ntz, open double, high double, low double, close double, "
    "tick_volume bigint, original_contract string"
)


def flat(symbol, day, price, contract):
    return (symbol, at(f"2026-08-{day:02d} 10:00:00"), price, price, price, price, 100, contract)


def closes(df, symbol="WIN$"):
    return [r["close"] for r in df.where(F.col("symbol") == symbol).orderBy("time").collect()]


@pytest.mark.parametrize("form", FORMS)
def test_one_rollover(spark, form):
    rows = [
        flat("WIN$", 19, 130000.0, "WINQ26"),
        flat("WIN$", 20, 131200.0, "WINU26"),
        flat("WIN$", 21, 131500.0, "WINU26"),
    ]
    spliced = form(spark.createDataFrame(rows, SCHEMA))
    assert closes(spliced) == [131200.0, 131200.0, 131500.0]
    assert "original_contract" not in spliced.columns


def test_one_rollover_through_the_whole_cleaning(spark):
    raw = [
        {
            "time": f"2026-08-{day} 10:00:00", "open": price, "high": price, "low": price,
            "close": price, "tick_volume": 100, "spread": 1, "real_volume": 1000,
            "original_contract": contract,
        }
        for day, price, contract in [
            (19, 130000.0, "WINQ26"), (20, 131200.0, "WINU26"), (21, 131500.0, "WINU26"),
        ]
    ]
    cleaned = clean_bars(raw, symbol="WIN$", strict=True)
    assert closes(cleaned) == [131200.0, 131200.0, 131500.0]


@pytest.mark.parametrize("form", FORMS)
def test_other_symbols_and_missing_contracts(spark, form):
    rows = [
        flat("PETR4", 19, 30.0, "A"), flat("PETR4", 20, 40.0, "B"),
        flat("WDO$", 19, 10.0, "A"), flat("WDO$", 20, 20.0, None), flat("WDO$", 21, 30.0, "B"),
        flat("WIN$", 19, 1.0, "A"), flat("WIN$", 20, 2.0, "B"), flat("WIN$", 21, 4.0, "A"),
    ]
    spliced = form(spark.createDataFrame(rows, SCHEMA))
    assert closes(spliced, "PETR4") == [30.0, 40.0]
    assert closes(spliced, "WDO$") == [10.0, 20.0, 30.0]
    assert closes(spliced, "WIN$") == [4.0, 4.0, 4.0]


def test_open_gap(spark):
    rows = [
        ("WIN$", at("2026-08-19 10:00:00"), 10.0, 12.0, 9.0, 11.0, 1, "A"),
        ("WIN$", at("2026-08-20 10:00:00"), 15.0, 18.0, 14.0, 17.0, 1, "B"),
    ]
    spliced = splice_series(spark.createDataFrame(rows, SCHEMA), gap_basis="open")
    assert closes(spliced) == [15.0, 17.0]


@pytest.mark.parametrize("slice_rows", [5, 100_000])
def test_many_rollovers_match_brute_force(spark, slice_rows):
    chance = random.Random(3)
    rows, expected = [], {}
    for symbol in ("WIN$", "WDO$N"):
        price, contract, moment, series = 100.0, 0, datetime(2026, 1, 1), []
        for _ in range(120):
            moment += timedelta(minutes=chance.choice([1, 5, 5000]))
            if chance.random() < 0.2:
                contract += 1
                price += chance.uniform(-5, 5)
            price += chance.uniform(-1, 1)
            series.append((symbol, moment, price, price + 1, price - 1, price, 1, f"C{contract}"))
        later, adjusted = 0.0, []
        for i in range(len(series) - 1, -1, -1):
            adjusted.append(series[i][5] + later)
            if i and series[i][7] != series[i - 1][7]:
                later += series[i][5] - series[i - 1][5]
        rows += series
        expected[symbol] = adjusted[::-1]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    sliced = balanced_slices(df, limit=slice_rows)
    for spliced in (splice_series(sliced), splice_broadcast(sliced)):
        for symbol, values in expected.items():
            assert closes(spliced, symbol) == pytest.approx(values)


def test_perpetual_roll(spark):
    schema = SCHEMA.replace("symbol", "root")
    front = spark.createDataFrame(
        [flat("WIN", 19, 100.0, "A"), flat("WIN", 20, 100.0, "A")], schema
    )
    following = front.where("time > '2026-08-20'").withColumns(
        {"close": F.lit(110.0), "tick_volume": F.lit(300).cast("bigint")}
    )
    rolled = perpetual_roll(front, following).collect()
    assert [(r["front_weight"], r["close"]) for r in rolled] == [(0.25, 107.5)]
    outer = perpetual_roll(front, following, how="outer").orderBy("time").collect()
    assert [(r["front_weight"], r["close"]) for r in outer] == [(1.0, 100.0), (0.25, 107.5)]
    silent = front.withColumn("tick_volume", F.lit(0).cast("bigint"))
    assert perpetual_roll(silent, silent).first()["front_weight"] == 1.0
