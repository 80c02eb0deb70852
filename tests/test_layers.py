from __future__ import annotations

import logging

import pandas as pd
import pytest
from conftest import at, bar_rows, many_bars
from pyspark.sql import functions as F

from barloom.operators.drift import drift_alerts, drift_audit
from barloom.operators.quality import DataQualityError
from barloom.plans.gold import build_gold, check_gold
from barloom.plans.medallion import run_layers
from barloom.plans.silver import build_silver
from barloom.session import work_folder
from barloom.sources.bronze import append_bars, append_ticks
from barloom.sources.layers import append_alerts, append_audit, read_alerts, read_layer, replace_series
from barloom.streaming.ticks import guard_ticks


def test_symbols_come_from_the_rows(spark, base):
    report = run_layers(spark, base, {"PETR4": bar_rows(25, "PETR4")}).collect()
    assert [(r["symbol"], r["validated_rows"]) for r in report] == [("PETR4", 15)]
    with pytest.raises(ValueError, match="B"):
        run_layers(spark, base, {"A": bar_rows(25, "A")}, symbols=["A", "B"])


def test_step_by_step(spark, base):
    assert append_bars(spark, base, bar_rows(25), "TEST$", "M5")
    build_silver(spark, base)
    build_gold(spark, base)
    report = check_gold(spark, base).collect()
    assert [(r["symbol"], r["is_valid"], r["validated_rows"]) for r in report] == [("TEST$", True, 15)]
    silver = read_layer(spark, base, "silver", "futures", "TEST$", "M5").orderBy("time").collect()
    assert len(silver) == 25
    assert silver[1]["frac_diff_close"] == pytest.approx(20.75 - 0.4 * 20.5)


def test_frame_with_many_series(spark, base):
    frame = many_bars(spark, ["A", "B", "C"], 30).withColumn(
        "timeframe", F.when(F.col("symbol") == "C", "M1").otherwise("M5")
    )
    report = run_layers(spark, base, frame).collect()
    assert {(r["symbol"], r["timeframe"], r["validated_rows"]) for r in report} == {
        ("A", "M5", 20), ("B", "M5", 20), ("C", "M1", 20),
    }


def test_later_batch_corrects_an_earlier_one(spark, base):
    rows = bar_rows(3)
    append_bars(spark, base, rows, "A", "M1")
    append_bars(spark, base, [{**rows[1], "close": 20.9}], "A", "M1")
    assert read_layer(spark, base, "bronze").count() == 4
    build_silver(spark, base)
    closes = [r["close"] for r in read_layer(spark, base, "silver").orderBy("time").collect()]
    assert closes == [20.5, 20.9, 21.0]


def test_strict_raises_and_quarantine_keeps(spark, base):
    rows = bar_rows(3)
    rows[1]["low"] = 1000.0
    append_bars(spark, base, rows, "A", "M1")
    with pytest.raises(DataQualityError):
        build_silver(spark, base)
    assert read_layer(spark, base, "silver").count() == 0
    build_silver(spark, base, strict=False)
    assert read_layer(spark, base, "silver").count() == 2
    assert [r["low"] for r in read_layer(spark, base, "quarantine").collect()] == [1000.0]


def test_missing_layers(spark, base, caplog):
    with caplog.at_level(logging.WARNING):
        assert read_layer(spark, base, "gold").count() == 0
    assert "no files" in caplog.text
    with pytest.raises(ValueError, match="no bronze"):
        build_silver(spark, base)
    with pytest.raises(ValueError, match="no silver"):
        build_gold(spark, base)


def test_ingest_results(spark, base):
    assert append_bars(spark, base, [], "A", "M1")
    assert not append_bars(spark, base, 42, "A", "M1")
    assert append_bars(spark, base, pd.DataFrame(bar_rows(2)), "A", "M1", "equities")
    assert read_layer(spark, base, "bronze", data_type="equities").count() == 2
    assert read_layer(spark, base, "bronze", data_type="futures").count() == 0


def test_replacing_one_series_leaves_others(spark, base):
    frame = many_bars(spark, ["007", "B"], 5).withColumns(
        {"data_type": F.lit("futures"), "timeframe": F.lit("M5")}
    )
    replace_series(frame, base, "silver")
    replace_series(frame.where("symbol = 'B'").limit(2), base, "silver")
    counts = read_layer(spark, base, "silver").groupBy("symbol").count().collect()
    assert {r["symbol"]: r["count"] for r in counts} == {"007": 5, "B": 2}


def test_key_predicate_prunes_directories(spark, base):
    append_bars(spark, base, bar_rows(2), "A", "M1")
    plan = read_layer(spark, base, "bronze", symbol="A")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


@pytest.mark.parametrize("age, kept", [(10, True), (10.5, False), (-5000, True)])
def test_tick_age(spark, base, age, kept):
    ticks = [{"time_msc": 0, "bid": 1.0}, {"time_msc": 1_000_000, "bid": 2.0}]
    assert append_ticks(spark, base, "WIN$", ticks, now_msc=1_000_000 + age) is kept


def test_ticks_without_time_or_rows(spark, base):
    assert append_ticks(spark, base, "WIN$", [])
    assert append_ticks(spark, base, "WIN$", [{"bid": 1.0}])
    assert read_layer(spark, base, "ticks").count() == 1


def test_alerts(spark, base):
    metrics = spark.createDataFrame(
        [("a", at("2026-08-19 10:00:00"), 1.2), ("b", at("2026-08-20 10:00:00"), 1.5),
         ("c", at("2026-08-20 10:00:00"), None)],
        "model string, ts timestamp_ntz, sharpe_ratio double",
    )
    append_alerts(drift_alerts(metrics), base)
    append_alerts(drift_alerts(metrics), base)
    alerts = read_alerts(spark, base).collect()
    assert sorted((r["model"], str(r["alert_date"])) for r in alerts) == [
        ("a", "2026-08-19"), ("c", "2026-08-20"),
    ]


def test_alerts_keep_their_other_metrics(spark, base):
    metrics = spark.createDataFrame(
        [("a", at("2026-08-19 10:00:00"), 1.2, 7.5)],
        "model string, ts timestamp_ntz, sharpe_ratio double, latency_ms double",
    )
    append_alerts(drift_alerts(metrics), base)
    assert read_alerts(spark, base).first()["metrics"] == '{"latency_ms":7.5}'


def test_one_bad_series_holds_no_other(spark, base):
    rows = bar_rows(5, "BAD")
    rows[2]["low"] = 1000.0
    frame = spark.createDataFrame(pd.DataFrame(rows)).unionByName(many_bars(spark, ["A", "B"], 5))
    append_bars(spark, base, frame, timeframe="M1")
    build_silver(spark, base)
    counts = read_layer(spark, base, "silver").groupBy("symbol").count().collect()
    assert {r["symbol"]: r["count"] for r in counts} == {"A": 5, "B": 5}
    refused = read_layer(spark, base, "quarantine").collect()
    assert [(r["symbol"], r["reason"]) for r in refused] == [("BAD", "price_rule")]


def test_a_series_without_rows_loses_its_files(spark, base):
    append_bars(spark, base, bar_rows(1, "A$ x"), "A$ x", "M1")
    append_bars(spark, base, bar_rows(3, "B"), "B", "M1")
    build_silver(spark, base)
    append_bars(spark, base, [{**bar_rows(1)[0], "high": 0.0}], "A$ x", "M1")
    build_silver(spark, base, strict=False)
    assert {r["symbol"] for r in read_layer(spark, base, "silver").collect()} == {"B"}
    assert read_layer(spark, base, "quarantine").count() == 1
    append_bars(spark, base, bar_rows(1), "A$ x", "M1")
    build_silver(spark, base)
    assert read_layer(spark, base, "quarantine").count() == 0
    assert {r["symbol"] for r in read_layer(spark, base, "silver").collect()} == {"A$ x", "B"}


def test_batches_name_and_type_their_time_differently(spark, base):
    first, second, third = bar_rows(2), bar_rows(2, start=2), bar_rows(2, start=4)
    append_bars(spark, base, first, "A", "M1")
    renamed = [{**{k: v for k, v in r.items() if k != "time"}, "timestamp": r["time"]} for r in second]
    append_bars(spark, base, renamed, "A", "M1")
    append_bars(spark, base, [{**r, "time": 1741000000 + k} for k, r in enumerate(third)], "A", "M1")
    build_silver(spark, base)
    assert read_layer(spark, base, "silver").count() == 6


def test_lists_and_streams_of_ticks_share_a_layout(spark, base, tmp_path):
    append_ticks(spark, base, "WIN$", [{"time_msc": 10, "bid": 1.0}], now_msc=10, batch_id=1)
    schema = "data_type string, symbol string, timeframe string, batch_id bigint, ingest_seq bigint, time_msc bigint"
    for number in (2, 3):  # two feeds, each with a checkpoint of its own
        source = str(tmp_path / f"feed{number}")
        rows = [("futures", "WIN$", "ticks", number, number, 10 * number)]
        spark.createDataFrame(rows, schema).write.parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        guard_ticks(
            stream, base, f"{base}/checkpoint{number}", clock=lambda: 5, availableNow=True
        ).awaitTermination()
    found = read_layer(spark, base, "ticks", symbol="WIN$").collect()
    assert {r["batch_id"] for r in found} == {1, 2, 3}


def test_work_folder_lies_in_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(f"{shared}/x-")


def test_a_reused_batch_number_keeps_both_lists(spark, base):
    for rows in ([10, 11, 12], [20, 21]):
        assert append_ticks(spark, base, "007", [{"time_msc": t, "bid": 1.0} for t in rows], now_msc=22, batch_id=4)
    assert read_layer(spark, base, "ticks").count() == 5
    assert read_layer(spark, base, "ticks", symbol="007").count() == 5


def test_missing_ticks_are_an_empty_frame(spark, base, caplog):
    with caplog.at_level(logging.WARNING):
        found = read_layer(spark, base, "ticks", symbol="A")
    assert found.count() == 0 and "time_msc" in found.columns and "no files" in caplog.text


def test_times_that_are_no_text_keep_their_fraction(spark, base):
    rows = [{**row, "time": at("2026-08-19 10:00:00.5")} for row in bar_rows(1)]
    append_bars(spark, base, rows, "A", "S1")
    append_bars(spark, base, [{**bar_rows(1)[0], "time": "2026-08-19 10:00:00.5"}], "A", "S1")
    build_silver(spark, base)
    assert [r["time"] for r in read_layer(spark, base, "silver").collect()] == [at("2026-08-19 10:00:00.5")]
    assert [r["reason"] for r in read_layer(spark, base, "quarantine").collect()] == ["unparsed_time"]


def test_one_bad_gold_series_is_reported_and_holds_no_other(spark, base):
    frame = many_bars(spark, ["A", "B"], 25).withColumns(
        {"data_type": F.lit("futures"), "timeframe": F.lit("M1"), "time": F.col("time").cast("timestamp_ntz")}
    )
    for name in ("tick_volume",):
        frame = frame.withColumn(name, F.when(F.col("symbol") == "A", -1).otherwise(F.col(name)))
    replace_series(frame, base, "gold")
    assert {r["symbol"]: r["is_valid"] for r in check_gold(spark, base).collect()} == {"A": False, "B": True}
    with pytest.raises(DataQualityError):
        check_gold(spark, base, symbol="A")


def test_the_latest_audit_counts(spark, base):
    def metrics(*rows):
        return spark.createDataFrame([(m, at("2026-08-19 10:00:00"), x) for m, x in rows], "model string, ts timestamp_ntz, sharpe_ratio double")

    append_audit(drift_audit(metrics(("a", 1.2), ("b", 1.1), ("c", 0.5))), base)
    append_audit(drift_audit(metrics(("a", 1.9), ("b", 0.3))), base)  # a was wrong, b is worse
    assert {(r["model"], r["sharpe_ratio"]) for r in read_alerts(spark, base).collect()} == {("b", 0.3), ("c", 0.5)}
