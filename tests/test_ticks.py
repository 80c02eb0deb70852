from __future__ import annotations

from conftest import at
from pyspark.sql import functions as F

from barloom.operators.ticks import flag_stale, stale_batches
from barloom.streaming.bars import stream_bars
from barloom.streaming.ticks import dead_letters, fresh_ticks, guard_ticks

SCHEMA = (
    "data_type string, symbol string, timeframe string, batch_id bigint, ingest_seq bigint, "
    "time_msc bigint, arrival_msc bigint"
)


def tick(batch, sequence, sent, arrival):
    return ("futures", "WIN$", "ticks", batch, sequence, sent, arrival)


TICKS = [
    tick(1, 1, 5000, 5000), tick(1, 2, 100, 5000),  # last sent tick is old
    tick(2, 3, 100, 200), tick(2, 4, 4990, 5000),  # last is 10 ms old: fresh
    tick(3, 5, 4989, 5000),
    tick(4, 6, 9000, 5000),  # from the future: fresh
    tick(5, 7, None, 5000),
]


def test_last_tick_by_arrival_decides(spark):
    df = spark.createDataFrame(TICKS, SCHEMA).repartition(3)
    assert {r["batch_id"] for r in stale_batches(df).collect()} == {1, 3}
    kept = flag_stale(df).where(~F.col("is_stale")).collect()
    assert {r["ingest_seq"] for r in kept} == {3, 4, 6, 7}


def test_batches_of_two_symbols_are_judged_apart(spark):
    rows = [tick(7, 1, 100, 5000), tick(7, 2, 5000, 5000)[:1] + ("WDO$",) + tick(7, 2, 5000, 5000)[2:]]
    flagged = flag_stale(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["symbol"]: r["is_stale"] for r in flagged} == {"WIN$": True, "WDO$": False}


def test_ticks_without_batch_number_stay(spark):
    rows = [tick(None, 1, 4995, 5000), tick(None, 2, 4995, 5000), tick(1, 3, 5000, 5000)]
    assert flag_stale(spark.createDataFrame(rows, SCHEMA)).where(~F.col("is_stale")).count() == 3


def test_a_batch_in_two_micro_batches_has_one_verdict(spark, base, tmp_path):
    source = str(tmp_path / "feed")
    for row in (tick(1, 1, 100, 5000), tick(1, 2, 4995, 5000)):
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    guard_ticks(stream, base, f"{base}/checkpoint", availableNow=True).awaitTermination()
    assert fresh_ticks(spark, base).count() == 2
    assert dead_letters(spark, base).count() == 0


def test_no_time_no_check(spark):
    df = spark.createDataFrame(TICKS, SCHEMA).drop("time_msc")
    assert flag_stale(df).where("is_stale").count() == 0


def test_stream_matches_batch(spark, base, tmp_path):
    source = str(tmp_path / "feed")
    df = spark.createDataFrame(TICKS, SCHEMA)
    df.where("batch_id < 3").coalesce(1).write.parquet(source)
    df.where("batch_id >= 3").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    guard_ticks(stream, base, f"{base}/checkpoint", availableNow=True).awaitTermination()
    fresh, dead = fresh_ticks(spark, base), dead_letters(spark, base)
    assert {r["ingest_seq"] for r in fresh.collect()} == {3, 4, 6, 7}
    assert {r["ingest_seq"] for r in dead.collect()} == {1, 2, 5}


def test_stream_uses_the_clock_without_stated_arrival(spark, base, tmp_path):
    source = str(tmp_path / "feed")
    df = spark.createDataFrame(TICKS, SCHEMA).drop("arrival_msc")
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    guard_ticks(
        stream, base, f"{base}/checkpoint", clock=lambda: 5000, availableNow=True
    ).awaitTermination()
    fresh = fresh_ticks(spark, base)
    assert {r["ingest_seq"] for r in fresh.collect()} == {3, 4, 6, 7}


def test_stream_bars_close_by_watermark(spark, tmp_path):
    source, out = str(tmp_path / "feed"), str(tmp_path / "out")
    rows = [
        (1, at("2026-01-01 09:00:01"), "A", 1.0), (2, at("2026-01-01 09:30:00"), "A", 3.0),
        (4, at("2026-01-01 09:59:00"), "A", 2.5), (3, at("2026-01-01 09:59:00"), "A", 2.0),
        (5, at("2026-01-01 10:30:00"), "A", 9.0),
    ]
    schema = "event_id bigint, ts timestamp_ntz, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(source)
    (
        stream_bars(spark.readStream.schema(schema).parquet(source))
        .writeStream.option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{out}/bars")
        .awaitTermination()
    )
    found = spark.read.parquet(f"{out}/bars").collect()
    assert [tuple(r) for r in found] == [("A", at("2026-01-01 09:00:00"), 1.0, 3.0, 1.0, 2.5, 4)]
