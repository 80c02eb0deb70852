"""Row-wise column expressions over one bar.

Logarithms of, and divisions by, zero give null here and drop out with the
other rows that lack a feature.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom import constants as C


def _squared_log(numerator: str, denominator: str) -> Column:
    ratio = F.ln(F.try_divide(F.col(numerator), F.col(denominator)))
    return ratio * ratio


def _root_of_positive(value: Column) -> Column:
    # greatest(value, 0) would turn null into 0
    return F.sqrt(F.when(value < 0, F.lit(0.0)).otherwise(value))


def garman_klass() -> Column:
    return _root_of_positive(
        F.lit(C.GARMAN_KLASS_RANGE) * _squared_log("high", "low")
        - F.lit(C.GARMAN_KLASS_BODY) * _squared_log("close", "open")
    )


def parkinson() -> Column:
    return _root_of_positive(_squared_log("high", "low") / F.lit(C.PARKINSON_DIVISOR))


def order_flow_imbalance() -> Column:
    body = F.col("close") - F.col("open")
    span = F.col("high") - F.col("low") + F.lit(C.DIVISION_GUARD)
    return F.try_divide(body, span) * F.col("tick_volume")
