from __future__ import annotations

import pandas as pd
import pytest
from conftest import at, bar_rows

from barloom.operators.conform import conform, drop_incomplete, fill_volumes
from barloom.operators.dedup import keep_last
from pyspark.sql import functions as F

from barloom.operators.quality import DataQualityError, series_verdicts
from barloom.plans.silver import clean_bars, prepare_bars

ORDERED = [
    "symbol", "time", "open", "high", "low", "close", "tick_volume", "spread", "real_volume",
]


def test_last_arrival_wins(spark):
    rows = [("A", 1, 10, "x"), ("A", 1, 12, "z"), ("A", 1, 11, "y"), ("B", 1, 1, "b"), ("A", 2, 0, "w")]
    df = spark.createDataFrame(rows, "symbol string, time int, ingest_seq int, v string")
    kept = {(r["symbol"], r["time"], r["v"]) for r in keep_last(df.repartition(3)).collect()}
    assert kept == {("A", 1, "z"), ("B", 1, "b"), ("A", 2, "w")}


def test_copies_shrink_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("'A' AS symbol", "id % 2 AS time", "id AS ingest_seq")
    plan = keep_last(df)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_conform_orders_and_fills(spark):
    df = spark.createDataFrame(
        [(1.0, 2, 3.0, 4.0, "A", at("2026-01-01"), None, "extra")],
        "close double, open int, high double, low double, symbol string, time timestamp_ntz, "
        "tick_volume bigint, other string",
    )
    result = fill_volumes(conform(df))
    assert result.columns == ORDERED
    row = result.first()
    assert (row["open"], row["tick_volume"], row["spread"], row["real_volume"]) == (2.0, 0, 0, 0)


def test_missing_price_is_an_error(spark):
    df = spark.createDataFrame([("A", "t", 1.0)], "symbol string, time string, close double")
    with pytest.raises(ValueError, match="open, high, low"):
        conform(df)


def test_incomplete_rows_go(spark):
    schema = "time string, open double, high double, low double, close double, spread bigint"
    rows = [("t", 1.0, 1.0, 1.0, 1.0, None), (None, 1.0, 1.0, 1.0, 1.0, 1), ("t", 1.0, None, 1.0, 1.0, 1)]
    assert drop_incomplete(spark.createDataFrame(rows, schema)).count() == 1


def test_two_spellings_of_one_instant_are_one_bar(spark):
    rows = bar_rows(2)
    rows[0]["time"], rows[1]["time"] = "2026-01-01 09:00:00", "2026-01-01T09:00:00"
    cleaned = clean_bars(rows).collect()
    assert [(r["time"], r["close"]) for r in cleaned] == [(at("2026-01-01 09:00:00"), 20.75)]


def test_a_midnight_bar_takes_no_other_bars_place(spark):
    rows = bar_rows(3)
    for row, hour in zip(rows, ("00", "09", "10")):
        row["time"] = f"2026-01-01 {hour}:00:00"
    frame = spark.createDataFrame(pd.DataFrame(rows))
    assert prepare_bars(frame).count() == 3
    hourly = prepare_bars(frame.withColumn("timeframe", F.lit("H1")))
    assert {r["time"].hour for r in hourly.collect()} == {0, 9, 10}
    daily = prepare_bars(frame.where("time like '%00:00:00'").withColumn("timeframe", F.lit("D1")))
    assert [r["time"].hour for r in daily.collect()] == [9]


def test_unparsed_times_are_all_seen(spark):
    rows = bar_rows(4)
    for row in rows[:3]:
        row["time"] = "soon"
    rows[1]["high"] = 1.0
    verdict = series_verdicts(prepare_bars(spark.createDataFrame(pd.DataFrame(rows)))).first()
    assert (verdict["bars"], verdict["unparsed_time"], verdict["held"]) == (4, 3, True)


def test_an_infinite_price_spoils_no_other_bar(spark):
    rows = [{**row, "original_contract": "A" if k < 6 else "B"} for k, row in enumerate(bar_rows(12))]
    rows[6]["close"] = rows[6]["high"] = float("inf")
    cleaned = clean_bars(spark.createDataFrame(pd.DataFrame(rows)), roots=None)
    assert cleaned.count() == 11
    assert cleaned.where("abs(close) < 100").count() == 11


def test_a_text_price_is_one_bad_bar(spark):
    rows = [{**row, "close": str(row["close"])} for row in bar_rows(3)]
    rows[2]["close"] = "n/a"
    assert clean_bars(spark.createDataFrame(pd.DataFrame(rows))).count() == 2


@pytest.mark.parametrize("form", ["list", "pandas", "spark"])
def test_input_forms(spark, form):
    rows = bar_rows(3)
    raw = {
        "list": rows,
        "pandas": pd.DataFrame(rows),
        "spark": spark.createDataFrame(pd.DataFrame(rows)),
    }[form]
    cleaned = clean_bars(raw)
    assert cleaned.columns == ORDERED
    assert cleaned.count() == 3


@pytest.mark.parametrize("empty", [[], pd.DataFrame()])
def test_no_rows_give_an_empty_frame(spark, empty):
    cleaned = clean_bars(empty)
    assert cleaned.count() == 0
    assert "close" in cleaned.columns


def test_epoch_seconds_and_timestamp_column(spark):
    rows = [{**row, "timestamp": 1787133600 + i} for i, row in enumerate(bar_rows(2))]
    for row in rows:
        del row["time"]
    times = [r["time"] for r in clean_bars(rows).orderBy("time").collect()]
    assert times == [at("2026-08-19 10:00:00"), at("2026-08-19 10:00:01")]


def test_bad_bars_raise_or_go(spark):
    rows = bar_rows(3)
    rows[1]["high"] = 1.0
    with pytest.raises(DataQualityError):
        clean_bars(rows, strict=True)
    assert [r["close"] for r in clean_bars(rows).orderBy("time").collect()] == [20.5, 21.0]


def test_unparsed_time_goes(spark):
    rows = bar_rows(2)
    rows[0]["time"] = "2026-01-01"
    assert clean_bars(rows).count() == 1
    df = spark.createDataFrame(pd.DataFrame(rows))
    assert prepare_bars(df).where("time IS NULL").count() == 1
