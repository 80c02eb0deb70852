"""Features of live bars: each series keeps its last rows as state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom import constants as C
from barloom.functions import prices
from barloom.functions.times import cyclic_time
from barloom.operators.fracdiff import frac_weights
from barloom.schemas import FEATURES, PRICES

#: Rows a series keeps: the fractional difference looks back furthest.
TAIL = C.FRAC_MAX_LAG + 1
FIELDS = ("time", *PRICES, "tick_volume")
ORDERED = ("log_return", "realized_volatility", "volume_momentum", "frac_diff_proxy", "frac_diff_close")
STATE = "waiting array<array<double>>, tail array<array<double>>"


def _recent(values: np.ndarray, rows: int) -> np.ndarray:
    """Each value with those before it, ``rows`` in all; not a number before the first."""
    padded = np.concatenate([np.full(rows - 1, np.nan), values])
    return np.lib.stride_tricks.sliding_window_view(padded, rows)


def ordered_features(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The features that look back, one row each; what can't be computed is not a number."""
    close, volume = rows[:, 4], rows[:, 5]
    log = np.log(close, out=np.full(len(close), np.nan), where=close > 0)
    change = np.diff(log, prepend=np.nan)
    lag = [np.concatenate([np.full(k, np.nan), close[: len(close) - k]]) if k < len(close) else close * np.nan for k in (1, 2)]
    known = np.nan_to_num(close)
    return np.stack(
        [
            change,
            np.std(_recent(change, C.ROLLING_ROWS), axis=1, ddof=1),
            volume / (np.mean(_recent(volume, C.ROLLING_ROWS), axis=1) + C.DIVISION_GUARD),
            close - C.PROXY_LAG_1 * lag[0] - C.PROXY_LAG_2 * lag[1],
            np.convolve(known, weights)[: len(known)],
        ],
        axis=1,
    )


def stream_features(
    bars: DataFrame, delay: str = "10 minutes", d: float = C.FRAC_ORDER, key: str = "symbol"
) -> DataFrame:
    """Features of a stream of bars, each bar once, when no earlier bar can come any more.

    The state of a series is its last 101 bars and the bars above the watermark, which wait
    there in whatever order they came; a timer lets them go when the watermark has passed
    them, also if the series has no further bars. Bars later than the watermark are dropped
    by Spark, and counted in the query's progress. Rows that lack a value, such as a
    series' first ten, are left out, as in the batch form.
    """
    weights = np.array(frac_weights(d))
    names = [*FIELDS, *ORDERED]

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, tail = map(list, state.get) if state.exists else ([], [])
        if not state.hasTimedOut:
            for frame in frames:
                waiting += frame[list(FIELDS)].astype("float64").to_numpy().tolist()
        passed = state.getCurrentWatermarkMs()
        waiting = sorted([list(row) for row in waiting], key=lambda row: row[0])
        ready = [row for row in waiting if row[0] < (passed + 1) * 1000]
        waiting = waiting[len(ready) :]
        if ready:
            rows = np.array([*tail, *ready], dtype=float)
            found = np.concatenate([rows, ordered_features(rows, weights)], axis=1)[len(tail) :]
            tail = rows[-TAIL:].tolist()
            yield pd.DataFrame(found, columns=names).assign(**{key: group[0]})
        state.update((waiting, tail))
        if waiting:
            state.setTimeoutTimestamp(max(passed + 1, int(waiting[0][0] // 1000) - 1))

    kinds = ", ".join(f"{name} double" for name in names)
    timed = bars.withColumn("_at", F.col("time").cast("timestamp"))
    found = (
        timed.withWatermark("_at", delay)
        .select(key, "_at", F.unix_micros("_at").cast("double").alias("time"), *FIELDS[1:])
        .groupBy(key)
        .applyInPandasWithState(step, f"{kinds}, {key} string", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
    row_wise = {
        "garman_klass_volatility": prices.garman_klass(),
        "parkinson_volatility": prices.parkinson(),
        "order_flow_imbalance": prices.order_flow_imbalance(),
        **cyclic_time(F.col("time")),
    }
    timed = found.withColumns(
        {
            "time": F.timestamp_micros(F.col("time").cast("bigint")).cast("timestamp_ntz"),
            "tick_volume": F.when(~F.isnan("tick_volume"), F.col("tick_volume")).cast("bigint"),
        }
    )
    columns = [key, *FIELDS, "frac_diff_close", *FEATURES]
    return timed.withColumns(row_wise).select(*columns).na.drop("any")


def store_features(features: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append features by micro-batch; a repeated one replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        (
            batch.withColumn("epoch", F.lit(epoch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("epoch")
            .parquet(path)
        )

    return (
        features.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def stored_features(spark: SparkSession, path: str, key: str = "symbol") -> DataFrame:
    numbers = ", ".join(f"{name} double" for name in (*PRICES, "frac_diff_close", *FEATURES))
    schema = f"{key} string, time timestamp_ntz, tick_volume bigint, {numbers}"
    return spark.read.schema(schema).parquet(path).select(key, *FIELDS, "frac_diff_close", *FEATURES)
