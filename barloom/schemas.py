"""Column sets of the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

KEY = ("data_type", "symbol", "timeframe")
PRICES = ("open", "high", "low", "close")
VOLUMES = ("tick_volume", "spread", "real_volume")
CONTRACT = "original_contract"
#: Start of the time range a file belongs to, in microseconds: a folder below the series' own.
PERIOD = "period"
#: Bronze times that did not come as text.
TIME_AT = "time_at"

_KEY_FIELDS = [T.StructField(name, T.StringType()) for name in KEY]
_BAR_FIELDS = [
    T.StructField("time", T.TimestampNTZType()),
    *[T.StructField(name, T.DoubleType()) for name in PRICES],
    *[T.StructField(name, T.LongType()) for name in VOLUMES],
]
FEATURES = (
    "log_return",
    "garman_klass_volatility",
    "parkinson_volatility",
    "realized_volatility",
    "order_flow_imbalance",
    "volume_momentum",
    "frac_diff_proxy",
    *[f"{unit}_{wave}" for unit in ("month", "weekday", "hour", "minute") for wave in ("sin", "cos")],
)

#: Clean bars in the prices of their own contract, and what splicing adds to those before a time.
CLEAN = T.StructType([*_BAR_FIELDS, T.StructField(CONTRACT, T.StringType()), *_KEY_FIELDS])
LEDGER = T.StructType(
    [T.StructField("time", T.TimestampNTZType()), T.StructField("later_gaps", T.DoubleType()), *_KEY_FIELDS]
)
TICKS = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("batch_id", "ingest_seq", "time_msc", "arrival_msc")],
        *_KEY_FIELDS,
        T.StructField("feed", T.StringType()),
        T.StructField("epoch", T.LongType()),
    ]
)
SILVER = T.StructType(
    [*_BAR_FIELDS, T.StructField("frac_diff_close", T.DoubleType()), *_KEY_FIELDS]
)
GOLD = T.StructType(
    [
        *SILVER.fields[: len(SILVER.fields) - len(KEY)],
        *[T.StructField(name, T.DoubleType()) for name in FEATURES],
        *_KEY_FIELDS,
    ]
)
QUARANTINE = T.StructType(
    [
        *_BAR_FIELDS,
        T.StructField(CONTRACT, T.StringType()),
        T.StructField("reason", T.StringType()),
        *_KEY_FIELDS,
    ]
)
ALERTS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("sharpe_ratio", T.DoubleType()),
        T.StructField("title", T.StringType()),
        T.StructField("metrics", T.StringType()),
        T.StructField("audit", T.LongType()),
        T.StructField("alert_date", T.DateType()),
    ]
)
BRONZE = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField(TIME_AT, T.TimestampNTZType()),
        *[T.StructField(name, T.DoubleType()) for name in PRICES],
        *[T.StructField(name, T.LongType()) for name in VOLUMES],
        T.StructField(CONTRACT, T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ingest_seq", T.LongType()),
        *_KEY_FIELDS,
    ]
)


def on_key(left: DataFrame, right: DataFrame) -> Column:
    """Null-safe equality of the key columns."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in KEY])


def series_key(df: DataFrame) -> list[str]:
    """The key columns a frame has; together they name one series."""
    return [name for name in KEY if name in df.columns]
