"""Batches judged as they close."""

from __future__ import annotations

import logging

from pyspark.sql import functions as F

from barloom.streaming.breaker import judge_batches, judged_ticks, read_verdicts, stored_dead_letters
from barloom.streaming.ticks import guard_ticks

SCHEMA = (
    "data_type string, symbol string, timeframe string, batch_id bigint, ingest_seq bigint, "
    "time_msc bigint, arrival_msc bigint, bid double"
)


def tick(symbol, batch, sequence, sent, arrival):
    return ("futures", symbol, "ticks", batch, sequence, sent, arrival, 1.5)


def feed(spark, base, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/feed")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/feed")
    guard_ticks(stream, base, f"{base}/guard", availableNow=True).awaitTermination()
    judge_batches(spark, base, f"{base}/judge", "1 second", "0 seconds", availableNow=True).awaitTermination()


def verdicts(frame):
    return {(r.symbol, r.batch_id, r.ingest_seq): r.is_stale for r in frame.collect()}


def test_batches_close_when_idle(spark, base, caplog):
    first = [
        tick("A", 1, 1, 5000, 5000), tick("A", 1, 2, 100, 5100),  # last sent tick is old
        tick("B", 1, 1, 100, 5000), tick("B", 1, 2, 5095, 5100),  # the same number in another series: fresh
        tick("A", 2, 3, 5990, 6000), tick("A", 3, 4, 5989, 6000), tick("A", None, 9, 5995, 6000),
    ]
    with caplog.at_level(logging.CRITICAL):
        feed(spark, base, first)
    # the stream ends at 6000: only what was idle for a second by then could close
    assert read_verdicts(spark, base).count() == 0
    with caplog.at_level(logging.CRITICAL):
        feed(spark, base, [tick("C", 8, 10, 20_000, 20_000)])
    closed = {(r.symbol, r.batch_id): (r.is_stale, r.ticks, r.age_msc) for r in read_verdicts(spark, base).collect()}
    assert closed == {
        ("A", 1): (True, 2, 5000), ("B", 1): (False, 2, 5), ("A", 2): (False, 1, 10), ("A", 3): (True, 1, 11),
    }
    assert "2 stale batches" in caplog.text
    dead = stored_dead_letters(spark, base)
    assert {(r.symbol, r.batch_id, r.ingest_seq) for r in dead.collect()} == {("A", 1, 1), ("A", 1, 2), ("A", 3, 4)}
    assert dead.select("bid").first().bid == 1.5
    judged = verdicts(judged_ticks(spark, base))
    assert judged == {
        ("A", 1, 1): True, ("A", 1, 2): True, ("B", 1, 1): False, ("B", 1, 2): False, ("A", 2, 3): False,
        ("A", 3, 4): True, ("A", None, 9): False, ("C", 8, 10): False,
    }


def test_a_tick_after_its_batch_closed_gets_the_verdict(spark, base):
    feed(spark, base, [tick("A", 1, 1, 100, 5000), tick("A", 2, 2, 5000, 5000)])
    feed(spark, base, [tick("B", 7, 3, 20_000, 20_000)])
    feed(spark, base, [tick("A", 1, 0, 4999, 5001)])  # late, and of a stale batch
    judged = verdicts(judged_ticks(spark, base))
    assert judged[("A", 1, 0)] and judged[("A", 1, 1)] and not judged[("A", 2, 2)]


def test_a_batch_that_goes_on_is_judged_by_its_last_tick(spark, base):
    feed(spark, base, [tick("A", 1, 1, 100, 5000)])
    feed(spark, base, [tick("A", 1, 2, 29_999, 30_000), tick("B", 7, 3, 60_000, 60_000)])
    assert read_verdicts(spark, base).where("symbol = 'A'").count() == 2
    assert not any(verdicts(judged_ticks(spark, base)).values())


def test_nothing_judged_yet(spark, base):
    assert judged_ticks(spark, base).count() == 0
    assert stored_dead_letters(spark, base).count() == 0
    assert read_verdicts(spark, base).where(F.col("is_stale")).count() == 0
