"""Layers brought up to date against a build of everything."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import bar_rows
from pyspark.sql import functions as F

from barloom.plans import incremental
from barloom.plans.gold import build_gold
from barloom.plans.incremental import update_layers
from barloom.plans.silver import build_silver
from barloom.schemas import PERIOD
from barloom.sources import layers
from barloom.sources.bronze import append_bars
from barloom.sources.layers import layer_files, layer_path, read_layer, replace_series

START = datetime(2025, 3, 3)


@pytest.fixture(autouse=True)
def short_ranges(monkeypatch):
    """Ranges of 64 minutes: shorter than the look-back of 101 rows."""
    monkeypatch.setattr(layers.period_of, "__defaults__", (64,))


def bars(symbol, first, count, contract=None, seed=1, step=0.0):
    chance = random.Random(f"{symbol}{first}{seed}")
    rows = []
    for k in range(first, first + count):
        low, high = sorted(20 + step + chance.random() * 9 for _ in range(2))
        rows.append(
            {
                "symbol": symbol, "timeframe": "M1", "time": (START + timedelta(minutes=k)).isoformat(" "),
                "open": low, "high": high, "low": low, "close": high, "tick_volume": k % 7 + 1,
                "original_contract": contract or "C1",
            }
        )
    return rows


BATCHES = {
    "a correction in the middle": [bars("WIN$", 0, 300) + bars("B", 0, 260), bars("WIN$", 150, 2, seed=5)],
    "a roll moves": [
        bars("WIN$", 0, 100) + bars("WIN$", 100, 100, "C2", step=3.0), bars("WIN$", 80, 30, "C2", seed=2, step=3.0),
    ],
    "bars before all others, and a new series": [bars("WIN$", 100, 200), bars("WIN$", 0, 50) + bars("new", 0, 30)],
    "bad bars and times": [
        bars("B", 0, 200),
        [
            {**bars("B", 70, 1)[0], "low": 99.0}, {**bars("B", 71, 1)[0], "time": "soon"},
            {**bars("C", 0, 1)[0], "time": None}, {**bars("B", 130, 1)[0], "close": float("inf")},
        ],
    ],
}


def rows_of(spark, base, layer):
    frame = read_layer(spark, base, layer)
    numbers = {f.name: F.round(f.name, 8) for f in frame.schema if f.dataType.typeName() == "double"}
    return sorted(map(repr, frame.withColumns(numbers).collect()))


@pytest.mark.parametrize("name", BATCHES)
def test_equal_to_a_build_of_everything(spark, base, name):
    whole = f"{base}-whole"
    for number, batch in enumerate(BATCHES[name], 1):
        for lake in (base, whole):
            assert append_bars(spark, lake, batch, batch_id=number)
        update_layers(spark, base)
    build_silver(spark, whole, strict=False)
    build_gold(spark, whole)
    for layer in ("silver", "gold", "quarantine"):
        assert rows_of(spark, base, layer) == rows_of(spark, whole, layer), layer
    assert update_layers(spark, base).count() == 0


def files_of(spark, base, layer, condition="true"):
    return {r.path for r in layer_files(spark, base, layer).where(condition).collect()}


def test_only_touched_ranges_are_written(spark, base):
    append_bars(spark, base, bars("WIN$", 0, 300) + bars("B", 0, 300), batch_id=1)
    update_layers(spark, base)
    before = {layer: files_of(spark, base, layer) for layer in ("clean", "silver", "gold")}
    append_bars(spark, base, bars("WIN$", 290, 2, seed=3), batch_id=2)
    (start,) = update_layers(spark, base).collect()
    assert start["symbol"] == "WIN$" and start["since"] is not None
    touched = f"symbol = 'WIN$' and {PERIOD} >= {start['since']}"
    for layer, old in before.items():
        now = files_of(spark, base, layer)
        assert old - files_of(spark, base, layer) and now - old, layer
        assert now - old == files_of(spark, base, layer, touched), layer


def test_a_contract_shifts_older_prices_of_its_series_only(spark, base):
    append_bars(spark, base, bars("WIN$", 0, 200) + bars("B", 0, 200), batch_id=1)
    update_layers(spark, base)
    clean, silver = files_of(spark, base, "clean"), files_of(spark, base, "silver", "symbol = 'B'")
    append_bars(spark, base, bars("WIN$", 200, 20, "C2"), batch_id=2)
    (start,) = update_layers(spark, base).collect()
    assert start["since"] is None
    assert files_of(spark, base, "silver", "symbol = 'B'") == silver
    # clean bars keep the prices of their contract
    assert len(clean - files_of(spark, base, "clean")) <= 1


def test_a_run_that_failed_is_done_again(spark, base, monkeypatch):
    append_bars(spark, base, bars("WIN$", 0, 150), batch_id=1)
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "technical_features", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update_layers(spark, base)
    assert update_layers(spark, base).count() == 1
    assert read_layer(spark, base, "gold").count() == 140


def test_nothing_to_build(spark, base):
    assert update_layers(spark, base).count() == 0


def keyed(spark, rows):
    frame = spark.createDataFrame(rows).withColumn("time", F.col("time").cast("timestamp_ntz"))
    return frame.withColumn("data_type", F.lit("futures"))


def test_a_shorter_series_loses_its_old_ranges(spark, base):
    replace_series(keyed(spark, bars("A", 0, 300) + bars("B", 0, 300)), base, "silver")
    replace_series(keyed(spark, bars("A", 0, 10)), base, "silver")
    counts = {r["symbol"]: r["count"] for r in read_layer(spark, base, "silver").groupBy("symbol").count().collect()}
    assert counts == {"A": 10, "B": 300}


def test_time_predicates_prune_ranges(spark, base):
    replace_series(keyed(spark, bars("A", 0, 300)), base, "silver")
    since, until = START + timedelta(minutes=70), START + timedelta(minutes=190)
    found = read_layer(spark, base, "silver", since=since, until=until)
    assert found.count() == 120
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "period" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    read = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert 0 < len(read) < len(files_of(spark, base, "silver"))


def test_a_long_series_is_written_by_many_tasks(spark, base):
    replace_series(layers.by_range(keyed(spark, bars("A", 0, 300))), base, "silver")
    assert len(files_of(spark, base, "silver")) >= 4


def test_each_row_is_computed_once(spark, base):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = keyed(spark, bars("A", 0, 20))
    for _ in range(2):
        replace_series(frame.mapInArrow(count, frame.schema), base, "silver", frame.select("data_type", "symbol", "timeframe"))
    assert seen.value == 40


def test_odd_names_of_series(spark, base):
    names = ["A+B", "50%", "a/b=c", "x y", "007", "Été", "*?[1]{2}"]
    append_bars(spark, base, [row for name in names for row in bars(name, 0, 12)], batch_id=1)
    update_layers(spark, base)
    append_bars(spark, base, [{**bars(name, 3, 1)[0], "low": 99.0} for name in names[:2]], batch_id=2)
    update_layers(spark, base)
    counts = {r["symbol"]: r["count"] for r in read_layer(spark, base, "silver").groupBy("symbol").count().collect()}
    assert counts == {name: 11 if name in names[:2] else 12 for name in names}
    assert os.path.isdir(layer_path(base, "clean"))


def test_gold_goes_with_silver(spark, base):
    append_bars(spark, base, bar_rows(25, "A") + bar_rows(25, "B"), timeframe="M1", batch_id=1)
    build_silver(spark, base)
    build_gold(spark, base)
    append_bars(spark, base, [{**row, "low": 1000.0} for row in bar_rows(25, "A")], timeframe="M1", batch_id=2)
    build_silver(spark, base, strict=False)
    build_gold(spark, base)
    for layer in ("silver", "gold"):
        assert {r["symbol"] for r in read_layer(spark, base, layer).collect()} == {"B"}
