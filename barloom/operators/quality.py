"""Bar integrity gate: counts, samples, quarantine and report."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions.checks import is_finite, is_spike, violates_ohlcv
from barloom.schemas import PRICES, series_key

log = logging.getLogger(__name__)


class DataQualityError(Exception):
    """Bars break a price or volume rule."""


def violations(df: DataFrame) -> DataFrame:
    return df.where(violates_ohlcv())


def spikes(df: DataFrame) -> DataFrame:
    return df.where(is_spike())


def samples(df: DataFrame, rule: Column, rows: int = C.SAMPLE_ROWS) -> DataFrame:
    """The first bars of each series that meet a rule, for a message or a log."""
    earliest = Window.partitionBy(*series_key(df)).orderBy("time", *df.columns)
    return (
        df.where(rule)
        .withColumn("sample", F.row_number().over(earliest))
        .where(F.col("sample") <= rows)
    )


def quality_report(df: DataFrame) -> DataFrame:
    """One row per series, from one pre-aggregated pass."""
    bad = F.count_if(violates_ohlcv())
    return df.groupBy(*series_key(df)).agg(
        (bad == 0).alias("is_valid"),
        F.count("*").alias("validated_rows"),
        bad.alias("violations"),
        F.count_if(is_spike()).alias("spikes"),
        F.count_if(F.col("time").isNull()).alias("unparsed_time"),
    )


def non_finite_counts(df: DataFrame) -> DataFrame:
    """Infinite and not-a-number values per series, one column per price."""
    return df.groupBy(*series_key(df)).agg(
        *[
            F.count_if(F.isnan(name) | (F.abs(F.col(name)) == F.lit(float("inf")))).alias(name)
            for name in PRICES
        ]
    )


def split_violations(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows."""
    bad = F.coalesce(violates_ohlcv(), F.lit(False))
    return df.where(~bad), df.where(bad)


def bar_fault(df: DataFrame) -> Column:
    """Why a bar can't go on, else null."""
    return (
        F.when(F.col("time").isNull(), "unparsed_time")
        .when(~is_finite(df.select(*PRICES)), "not_finite")
        .when(F.coalesce(violates_ohlcv(), F.lit(False)), "price_rule")
        .when(F.col("high").isNull() | F.col("low").isNull(), "missing_price")
    )


def split_bars(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good bars, and the others with a ``reason``; every bar is in one of them."""
    judged = df.withColumn("reason", bar_fault(df))
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def series_verdicts(df: DataFrame) -> DataFrame:
    """Per series the number of bars by fault; ``held`` if one breaks a price rule."""
    reason = F.col("reason")
    names = ("unparsed_time", "not_finite", "price_rule", "missing_price")
    return (
        df.withColumn("reason", bar_fault(df))
        .groupBy(*series_key(df))
        .agg(
            F.count("*").alias("bars"),
            *[F.count_if(reason == name).alias(name) for name in names],
            (F.count_if(F.coalesce(violates_ohlcv(), F.lit(False))) > 0).alias("held"),
        )
    )


def require_valid(df: DataFrame) -> DataFrame:
    """Raise on the first bad bar, warn about spikes; returns the frame unchanged.

    One aggregation over the bars; samples are read only when there is something
    to show.
    """
    counts = df.agg(
        F.count_if(violates_ohlcv()).alias("violations"), F.count_if(is_spike()).alias("spikes")
    ).first()
    shown = [*series_key(df), "time", "open", "high", "low", "close"]
    if counts["violations"]:
        rows = violations(df).select(*shown).orderBy(*shown).limit(C.SAMPLE_ROWS).collect()
        raise DataQualityError(
            f"price integrity check failed for {counts['violations']} bars, for example {rows}"
        )
    if counts["spikes"]:
        rows = spikes(df).select(*shown).orderBy(*shown).limit(C.SAMPLE_ROWS).collect()
        log.warning(
            "%d bars move more than %d%% within the bar, for example %s",
            counts["spikes"], round(100 * C.SPIKE_RANGE), rows,
        )
    return df


def validate(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(good, quarantine, report)``; with ``strict`` a bad bar raises instead."""
    if strict:
        require_valid(df)
    good, bad = split_violations(df)
    return good, bad, quality_report(df)
