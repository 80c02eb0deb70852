"""Live bars: events aggregated per time window, closed by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.streaming.query import StreamingQuery

from barloom.operators.bars import arrival_order, ohlc_aggregates
from barloom.operators.dedup import keep_last


def stream_bars(
    events: DataFrame,
    span: str = "1 hour",
    delay: str = "10 minutes",
    symbol: str = "event_type",
    time: str = "ts",
    value: str = "value",
    sequence: str = "event_id",
) -> DataFrame:
    """Bars of a stream; in append mode each comes once, when no event can change it.

    The state holds one short row per open bar, whatever the event rate.
    """
    return (
        events.withColumn(time, F.col(time).cast("timestamp"))  # watermarks need a zone
        .withWatermark(time, delay)
        .groupBy(F.col(symbol).alias("symbol"), F.window(time, span).alias("_window"))
        .agg(*ohlc_aggregates(value, arrival_order(time, sequence)))
        .select(
            "symbol",
            F.col("_window.start").cast("timestamp_ntz").alias("time"),
            "open", "high", "low", "close", "tick_volume",
        )
    )


def store_bars(bars: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Store every change of a bar, open ones included; a repeated micro-batch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        (
            batch.withColumn("epoch", F.lit(epoch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("epoch")
            .parquet(path)
        )

    return (
        bars.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def stored_bars(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of each bar, the open ones at the end included."""
    return keep_last(spark.read.parquet(path), ["epoch"]).drop("epoch")
