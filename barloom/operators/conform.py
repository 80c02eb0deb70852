"""Column set, defaults and row filters of the silver layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.checks import is_finite
from barloom.schemas import CONTRACT, KEY, PRICES, VOLUMES


def conform(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The silver columns in order; absent volumes become 0, absent prices are an error."""
    absent = [name for name in ("symbol", "time", *PRICES) if name not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    volumes = [
        F.col(name).try_cast("bigint").alias(name) if name in df.columns
        else F.lit(0).cast("bigint").alias(name)
        for name in VOLUMES
    ]
    rest = [name for name in (CONTRACT, *keep) if name in df.columns]
    keys = [name for name in KEY if name in df.columns and name != "symbol"]
    return df.select(
        "symbol",
        "time",
        *[F.col(name).try_cast("double").alias(name) for name in PRICES],
        *volumes,
        *keys,
        *rest,
    )


def fill_volumes(df: DataFrame) -> DataFrame:
    return df.na.fill(0, [name for name in VOLUMES if name in df.columns])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows without a time or one of the four prices."""
    return df.na.drop(subset=["time", *PRICES])


def keep_finite(df: DataFrame) -> DataFrame:
    return df.where(is_finite(df))
