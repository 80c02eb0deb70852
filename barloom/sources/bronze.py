"""Bronze ingest: raw bars and ticks, appended."""

from __future__ import annotations

import logging
import time
import uuid
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import constants as C
from barloom.functions.times import normalized_time, time_column
from barloom.schemas import CONTRACT, PRICES, TIME_AT, VOLUMES
from barloom.sources.layers import DEFAULT_DATA_TYPE, append_rows, store_ticks

log = logging.getLogger(__name__)

TICKS = "ticks"


def as_frame(spark: SparkSession, raw: Any) -> DataFrame:
    """A Spark frame from rows, a pandas frame, or a Spark frame."""
    if isinstance(raw, DataFrame):
        return raw
    if isinstance(raw, pd.DataFrame):
        return spark.createDataFrame(pa.Table.from_pandas(raw, preserve_index=False))
    if isinstance(raw, list):
        names = dict.fromkeys(name for row in raw for name in row)
        return spark.createDataFrame(pa.table({n: [row.get(n) for row in raw] for n in names}))
    raise TypeError(f"cannot read rows from {type(raw).__name__}")


def _is_empty_input(raw: Any) -> bool:
    return isinstance(raw, list) and not raw


def _typed(df: DataFrame) -> DataFrame:
    """Prices, volumes and the time in one type, so that appended files agree; the rest as sent.

    What is no number becomes null, and the gate names the row. A time that came as text
    is stored as sent in ``time``, whatever its column was called; any other in ``time_at``.
    """
    kinds = {
        **dict.fromkeys(PRICES, "double"),
        **dict.fromkeys(VOLUMES, "bigint"),
        CONTRACT: "string",
    }
    source = time_column(df)
    if source in df.columns:
        if isinstance(df.schema[source].dataType, T.StringType):
            times = {"time": F.col(source)}
        else:
            times = {TIME_AT: normalized_time(df, source), "time": F.lit(None).cast("string")}
        df = df.withColumns(times).drop(*({source} - {"time"}))
    return df.withColumns({n: F.col(n).try_cast(k) for n, k in kinds.items() if n in df.columns})


def stamped(
    df: DataFrame,
    symbol: str | None,
    timeframe: str | None,
    data_type: str | None,
    batch_id: int | None,
) -> DataFrame:
    """Add the series key and the arrival order, which is written once and never recomputed."""
    columns = {
        "data_type": F.lit(data_type or DEFAULT_DATA_TYPE),
        "batch_id": F.lit(time.time_ns() // 1000 if batch_id is None else batch_id).cast("bigint"),
    }
    if symbol is not None:
        columns["symbol"] = F.lit(symbol)
    if timeframe is not None:
        columns["timeframe"] = F.lit(timeframe)
    if "ingest_seq" not in df.columns:
        columns["ingest_seq"] = F.monotonically_increasing_id()
    return df.withColumns(columns)


def append_bars(
    spark: SparkSession,
    base: str,
    raw: Any,
    symbol: str | None = None,
    timeframe: str | None = None,
    data_type: str | None = None,
    batch_id: int | None = None,
) -> bool:
    """Append raw bars; a frame with its own ``symbol`` and ``timeframe`` holds many series.

    An empty list succeeds, input of an unknown type or a failed write does not.
    """
    try:
        if _is_empty_input(raw):
            return True
        rows = stamped(_typed(as_frame(spark, raw)), symbol, timeframe, data_type, batch_id)
        append_rows(rows, base, "bronze")
        return True
    except Exception:
        log.exception("raw bars were not saved")
        return False


def append_ticks(
    spark: SparkSession,
    base: str,
    symbol: str,
    ticks: list[dict[str, Any]],
    now_msc: float | None = None,
    batch_id: int | None = None,
) -> bool:
    """Append one batch of ticks, unless its last tick is more than 10 ms old.

    This is the entry for a feed handler's small list; tables and streams of
    ticks go through ``operators.ticks`` and ``streaming.ticks``.
    """
    try:
        if not ticks:
            return True
        sent = ticks[-1].get("time_msc")
        now = time.time() * 1000 if now_msc is None else now_msc
        if sent is not None and now - sent > C.MAX_TICK_AGE_MS:
            log.critical("stale batch of %s dropped: %.1f ms old", symbol, now - sent)
            return False
        rows = stamped(as_frame(spark, ticks), symbol, TICKS, None, batch_id)
        # a number of its own for each list: a batch number may come again
        store_ticks(
            rows.withColumn("arrival_msc", F.lit(int(now)).cast("bigint")), base, "list", uuid.uuid4().int >> 65
        )
        return True
    except Exception:
        log.exception("ticks were not saved")
        return False
