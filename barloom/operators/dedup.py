"""Duplicate bars: the last to arrive wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.schemas import series_key


def keep_last(
    df: DataFrame, arrival: Sequence[str] = ("ingest_seq",), time: str = "time"
) -> DataFrame:
    """One row per series and time; rows without a time are no duplicates of each other.

    Partitioned by time as well, so one large symbol spreads over all tasks.
    Spark limits every map task to one row per group before the shuffle, so
    neither does a bar sent a billion times reach one task.
    """
    apart = [F.when(F.col(time).isNull(), F.col(c)) for c in arrival]
    last_first = Window.partitionBy(*series_key(df), time, *apart).orderBy(
        *[F.desc(c) for c in arrival]
    )
    return (
        df.withColumn("_rank", F.row_number().over(last_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
