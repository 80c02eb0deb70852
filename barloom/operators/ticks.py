"""Circuit breaker for tick batches that arrive late."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.schemas import series_key


def batch_ages(ticks: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Per batch of a series the age in milliseconds of its last tick by arrival order.

    Integers throughout: a batch is stale when older than 10 ms, not at 10.
    """
    now = F.col("arrival_msc") if arrival is None else arrival
    return (
        ticks.groupBy(*series_key(ticks), "batch_id")
        .agg(
            F.max_by("time_msc", "ingest_seq").alias("last_time_msc"),
            F.max_by(now, F.col("ingest_seq")).alias("last_arrival_msc"),
            F.count("*").alias("ticks"),
        )
        .withColumn("age_msc", F.col("last_arrival_msc") - F.col("last_time_msc"))
        .withColumn(
            "is_stale", F.coalesce(F.col("age_msc") > F.lit(C.MAX_TICK_AGE_MS), F.lit(False))
        )
    )


def stale_batches(ticks: DataFrame) -> DataFrame:
    return batch_ages(ticks).where("is_stale")


def flag_stale(ticks: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Ticks with ``is_stale``, true for every tick of a stale batch.

    The verdicts are one short row per batch but grow with the data, so the join
    is left to the runtime, which broadcasts a small table and splits a batch
    that is too large for one task.
    """
    if "time_msc" not in ticks.columns:
        return ticks.withColumn("is_stale", F.lit(False))
    keys = [*series_key(ticks), "batch_id"]
    verdicts = batch_ages(ticks, arrival).select(*keys, "is_stale").alias("v")
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"v.{k}")) for k in keys])
    return ticks.alias("t").join(verdicts, same, "left").select("t.*", "v.is_stale")
