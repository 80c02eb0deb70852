"""Column expressions over time: normalisation, session opening, cyclic features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import constants as C

DEFAULT_STEP_SECONDS = 60.0
TICK_STEP_SECONDS = 0.1
_UNIT_SECONDS = {"S": 1, "M": 60, "H": 3600, "D": 86400, "W": 604800, "MN": 2592000}

_MAIL_DATE = (
    r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun), (\d{1,2} [A-Z][a-z]{2} \d{4} \d{1,2}:\d{2}:\d{2}) \S+$"
)


def time_column(df: DataFrame) -> str:
    return "timestamp" if "timestamp" in df.columns else "time"


def _ntz(value: Column) -> Column:
    return value.cast("timestamp_ntz")


def _mail_time(text: Column) -> Column:
    """``Wed, 19 Aug 2026 10:00:00 GMT``: any zone name, wall clock kept.

    Spark's parser has no weekday letter, so the weekday is cut off, and then
    compared with that of the parsed date.
    """
    parsed = F.try_to_timestamp(
        F.nullif(F.regexp_extract(text, _MAIL_DATE, 2), F.lit("")), F.lit("d MMM yyyy H:mm:ss")
    )
    weekday = F.regexp_extract(text, _MAIL_DATE, 1)
    return F.when(F.date_format(parsed, "EEE") == weekday, parsed)


def parse_time_text(text: Column) -> Column:
    """The first of the known layouts that fits, else null."""
    return _ntz(
        F.coalesce(
            F.when(text.contains(","), _mail_time(text)),
            F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
            F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
        )
    )


def normalized_time(df: DataFrame, name: str | None = None) -> Column:
    """Wall-clock time without zone, chosen by the type of the time column."""
    name = name or time_column(df)
    value, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return _ntz(value)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return _ntz(F.timestamp_seconds(value))
    if isinstance(kind, T.StringType):
        return parse_time_text(value)
    return value


def session_open(time: Column, symbol: Column) -> Column:
    """Bars stamped 00:00 are daily bars: move them to the opening hour."""
    hours = F.when(symbol.endswith(C.CONTINUOUS_SUFFIX), C.CONTINUOUS_OPEN_HOUR).otherwise(
        C.OTHER_OPEN_HOUR
    )
    at_midnight = (F.hour(time) == 0) & (F.minute(time) == 0)
    moved = time + F.make_dt_interval(F.lit(0), hours, F.lit(0), F.lit(0))
    return F.when(at_midnight, moved).otherwise(time)


def is_daily(timeframe: Column) -> Column:
    """Whether a label names bars of a day or longer; so does a missing label."""
    return F.coalesce(timeframe.rlike(r"^(D|W|MN)\d*$"), F.lit(True))


def step_seconds_of(timeframe: Column) -> Column:
    """Bar length of a label such as ``M5``, ``H1``, ``D1`` or ``MN1``; ticks count as ten a second."""
    label = r"^(MN|[SMHDW])(\d{1,4})$"
    count = F.nullif(F.regexp_extract(timeframe, label, 2), F.lit("")).cast("int")
    unit = F.when(timeframe == "ticks", TICK_STEP_SECONDS).otherwise(DEFAULT_STEP_SECONDS)
    for name, seconds in _UNIT_SECONDS.items():
        unit = F.when(F.regexp_extract(timeframe, label, 1) == name, seconds).otherwise(unit)
    return unit * F.greatest(F.coalesce(count, F.lit(1)), F.lit(1))


def truncated(time: Column, unit: str) -> Column:
    return _ntz(F.date_trunc(unit, time))


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a timestamp, as bigint."""
    return F.unix_micros(time.cast("timestamp"))


def cyclic_time(time: Column) -> dict[str, Column]:
    """Sine and cosine of month, ISO weekday, hour and minute."""
    cycles = {
        "month": (F.month(time), 12.0),
        "weekday": (F.weekday(time) + 1, 7.0),
        "hour": (F.hour(time), 24.0),
        "minute": (F.minute(time), 60.0),
    }
    columns = {}
    for name, (value, period) in cycles.items():
        angle = F.lit(2 * math.pi) * value / F.lit(period)
        columns[f"{name}_sin"] = F.sin(angle)
        columns[f"{name}_cos"] = F.cos(angle)
    return columns
