"""Technical features of the gold layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions import prices
from barloom.functions.times import cyclic_time
from barloom.operators.series import over_series
from barloom.schemas import GOLD


def _log_return(window: WindowSpec) -> Column:
    return F.ln("close") - F.ln(F.lag("close").over(window))


def _recent(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(1 - C.ROLLING_ROWS, 0)


def _realized_volatility(window: WindowSpec) -> Column:
    """Sample deviation of the last ten log returns; null until there are ten."""
    value = F.col("log_return")
    recent = _recent(window)
    return F.when(F.count(value).over(recent) >= C.ROLLING_ROWS, F.stddev_samp(value).over(recent))


def _volume_momentum(window: WindowSpec) -> Column:
    volume = F.col("tick_volume")
    recent = _recent(window)
    mean = F.when(F.count(volume).over(recent) >= C.ROLLING_ROWS, F.avg(volume).over(recent))
    return F.try_divide(volume, mean + F.lit(C.DIVISION_GUARD))


def _frac_diff_proxy(window: WindowSpec) -> Column:
    return (
        F.col("close")
        - F.lit(C.PROXY_LAG_1) * F.lag("close", 1).over(window)
        - F.lit(C.PROXY_LAG_2) * F.lag("close", 2).over(window)
    )


def log_return(df: DataFrame) -> DataFrame:
    return over_series(df, 1, lambda s, w: s.withColumn("log_return", _log_return(w)))


def percent_return(df: DataFrame) -> DataFrame:
    def build(s: DataFrame, w: WindowSpec) -> DataFrame:
        before = F.lag("close").over(w)
        return s.withColumn("percent_return", F.try_divide(F.col("close") - before, before))

    return over_series(df, 1, build)


def realized_volatility(df: DataFrame) -> DataFrame:
    return over_series(
        df,
        C.ROLLING_ROWS,
        lambda s, w: s.withColumn("log_return", _log_return(w)).withColumn(
            "realized_volatility", _realized_volatility(w)
        ),
    )


def volume_momentum(df: DataFrame) -> DataFrame:
    return over_series(
        df,
        C.ROLLING_ROWS - 1,
        lambda s, w: s.withColumn("volume_momentum", _volume_momentum(w)),
    )


def frac_diff_proxy(df: DataFrame) -> DataFrame:
    return over_series(df, 2, lambda s, w: s.withColumn("frac_diff_proxy", _frac_diff_proxy(w)))


def with_cyclic_time(df: DataFrame) -> DataFrame:
    return df.withColumns(cyclic_time(F.col("time")))


def technical_features(df: DataFrame) -> DataFrame:
    """All features; rows that lack any value, such as a series' first ten, are dropped.

    Everything ordered shares one shuffle and one sort; the rest is row-wise. A
    frame without ``time`` holds no bars and gives none.
    """
    if "time" not in df.columns:
        return df.sparkSession.createDataFrame([], GOLD)

    def build(s: DataFrame, w: WindowSpec) -> DataFrame:
        return s.withColumns(
            {
                "log_return": _log_return(w),
                "volume_momentum": _volume_momentum(w),
                "frac_diff_proxy": _frac_diff_proxy(w),
            }
        ).withColumn("realized_volatility", _realized_volatility(w))

    row_wise = {
        "garman_klass_volatility": prices.garman_klass(),
        "parkinson_volatility": prices.parkinson(),
        "order_flow_imbalance": prices.order_flow_imbalance(),
        **cyclic_time(F.col("time")),
    }
    return over_series(df, C.ROLLING_ROWS, build).withColumns(row_wise).na.drop("any")
