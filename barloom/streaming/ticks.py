"""Live ticks: every tick is stored, and judged with its whole batch when it is read."""

from __future__ import annotations

import time
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from barloom.operators.ticks import flag_stale
from barloom.sources.layers import read_ticks, store_ticks


def _now_msc() -> int:
    return time.time_ns() // 1_000_000


def guard_ticks(
    ticks: DataFrame,
    base: str,
    checkpoint: str,
    clock: Callable[[], int] = _now_msc,
    feed: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Store a stream of ticks, with the time of their arrival, in the tick dataset.

    ``ticks`` streams the key columns, ``batch_id``, ``ingest_seq`` and ``time_msc``.
    Arrival is ``arrival_msc`` if the feed states it, else the clock when the
    micro-batch starts. Rows are filed under the feed (by default, one per
    checkpoint) and the micro-batch, so a repeated micro-batch replaces its own rows
    and two feeds never touch each other's. A batch may come in several
    micro-batches: ``fresh_ticks`` and ``dead_letters`` judge it as a whole.
    """
    stated = "arrival_msc" in ticks.columns
    name = feed or sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, epoch: int) -> None:
        if not stated:
            batch = batch.withColumn("arrival_msc", F.lit(clock()).cast("bigint"))
        store_ticks(batch, base, name, epoch)

    return (
        ticks.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def fresh_ticks(spark: SparkSession, base: str) -> DataFrame:
    """Stored ticks of batches that came in time, and of those without batch or time."""
    return flag_stale(read_ticks(spark, base)).where(~F.col("is_stale")).drop("is_stale")


def dead_letters(spark: SparkSession, base: str) -> DataFrame:
    """Stored ticks of batches that came too late."""
    return flag_stale(read_ticks(spark, base)).where("is_stale").drop("is_stale")
