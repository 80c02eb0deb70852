"""The tick breaker with state: batches are judged when they close, and dead letters kept apart.

Stored ticks are read as a stream. A batch of a series is one row of state, whatever the
number of its ticks, until no tick of it has arrived for ``idle``; then the watermark
closes it, and its verdict goes to the ``verdicts`` dataset. The ticks of batches that came
too late are copied to the ``dead_letters`` dataset, and logged. Readers take the verdicts
of closed batches from there and judge only the open ones.

A tick that is stored after its batch has closed gets that batch's verdict when it is
read; if a batch goes on after ``idle``, it closes again and the verdict of its last tick
counts for all of it.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from barloom import constants as C
from barloom.operators.ticks import flag_stale
from barloom.schemas import KEY, TICKS, on_key
from barloom.sources.layers import layer_path, read_ticks, stage

log = logging.getLogger(__name__)

VERDICTS = (
    "data_type string, symbol string, timeframe string, batch_id bigint, last_seq bigint, ticks bigint,"
    " first_arrival_msc bigint, last_arrival_msc bigint, age_msc bigint, is_stale boolean, epoch bigint"
)


def batch_verdicts(ticks: DataFrame, idle: str = "10 seconds", delay: str = "10 seconds") -> DataFrame:
    """One row for each batch of a stream of ticks, when it has been idle."""
    arrived = F.timestamp_millis(F.col("arrival_msc"))
    age = F.max_by(F.col("arrival_msc") - F.col("time_msc"), F.col("ingest_seq"))
    return (
        ticks.where("batch_id is not null and arrival_msc is not null")
        .withColumn("_arrived", arrived)
        .withWatermark("_arrived", delay)
        .groupBy(*KEY, "batch_id", F.session_window("_arrived", idle).alias("_open"))
        .agg(
            F.max("ingest_seq").alias("last_seq"),
            F.count("*").alias("ticks"),
            F.min("arrival_msc").alias("first_arrival_msc"),
            F.max("arrival_msc").alias("last_arrival_msc"),
            age.alias("age_msc"),
        )
        .withColumn("is_stale", F.coalesce(F.col("age_msc") > C.MAX_TICK_AGE_MS, F.lit(False)))
        .drop("_open")
    )


def _written(df: DataFrame, epoch: int, path: str) -> None:
    (
        df.withColumn("epoch", F.lit(epoch).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch")
        .parquet(path)
    )


def judge_batches(
    spark: SparkSession, base: str, checkpoint: str, idle: str = "10 seconds", delay: str = "10 seconds", **trigger
) -> StreamingQuery:
    """Close batches of the stored ticks; a repeated micro-batch replaces what it wrote."""
    stream = spark.readStream.schema(TICKS).parquet(layer_path(base, "ticks"))

    def write(closed: DataFrame, epoch: int) -> None:
        path = layer_path(base, "verdicts")
        _written(closed, epoch, path)
        session = closed.sparkSession
        now = read_verdicts(session, base).where(F.col("epoch") == epoch)
        stale = stage(now.where("is_stale"), "stale")
        ends = stale.agg(
            F.min("first_arrival_msc").alias("first"), F.max("last_arrival_msc").alias("last"), F.count("*").alias("n")
        ).first()
        if not ends["n"]:
            return
        # the files of other times are left out by their statistics
        ticks = read_ticks(session, base).where(F.col("arrival_msc").between(ends["first"], ends["last"]))
        same = on_key(ticks, stale) & (ticks["batch_id"] == stale["batch_id"])
        _written(ticks.drop("epoch").join(stale, same, "left_semi"), epoch, layer_path(base, "dead_letters"))
        log.critical(
            "%d stale batches, for example %s", ends["n"], stale.select(*KEY, "batch_id", "age_msc").take(C.SAMPLE_ROWS)
        )

    return (
        batch_verdicts(stream, idle, delay)
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def read_verdicts(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(VERDICTS).parquet(layer_path(base, "verdicts"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERDICTS)


def judged_ticks(spark: SparkSession, base: str) -> DataFrame:
    """Every stored tick with ``is_stale``: by its batch's verdict, or judged now if it is open."""
    ticks = read_ticks(spark, base)
    last = (
        read_verdicts(spark, base)
        .groupBy(*KEY, "batch_id")
        .agg(F.max_by("is_stale", F.struct("last_seq", "last_arrival_msc")).alias("_verdict"))
    )
    same = on_key(ticks, last) & (ticks["batch_id"] == last["batch_id"])
    joined = ticks.join(last, same, "left").select(*[ticks[name] for name in ticks.columns], "_verdict")
    closed = joined.where("_verdict is not null").withColumnRenamed("_verdict", "is_stale")
    return closed.unionByName(flag_stale(joined.where("_verdict is null").drop("_verdict")))


def stored_dead_letters(spark: SparkSession, base: str) -> DataFrame:
    """The copied ticks of closed batches that came too late."""
    schema = read_ticks(spark, base).schema
    try:
        return spark.read.schema(schema).parquet(layer_path(base, "dead_letters"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
