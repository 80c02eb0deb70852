"""From raw bars to clean, continuous bars."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions.times import is_daily, normalized_time, session_open, time_column
from barloom.operators.conform import conform, drop_incomplete, fill_volumes, keep_finite
from barloom.operators.dedup import keep_last
from barloom.operators.fracdiff import fractional_difference
from barloom.operators.quality import (
    DataQualityError,
    require_valid,
    series_verdicts,
    split_bars,
)
from barloom.operators.series import balanced_slices
from barloom.operators.splice import splice_series
from barloom.schemas import KEY, SILVER, TIME_AT, on_key
from barloom.sources.bronze import as_frame
from barloom.sources.layers import by_range, read_layer, replace_series, stage

log = logging.getLogger(__name__)


def normalize_time(df: DataFrame) -> DataFrame:
    """Replace the time column, and that of stored times, by wall-clock ``time``."""
    source = time_column(df)
    time = normalized_time(df, source)
    if TIME_AT in df.columns:
        time = F.coalesce(F.col(TIME_AT), time)
    return df.withColumn("time", time).drop(*({source, TIME_AT} - {"time"}))


def open_daily_bars(df: DataFrame) -> DataFrame:
    """Move midnight bars of daily and unlabelled series to the opening hour.

    Intraday series have a bar of their own at midnight, which stays.
    """
    opened = session_open(F.col("time"), F.col("symbol"))
    if "timeframe" in df.columns:
        opened = F.when(is_daily(F.col("timeframe")), opened).otherwise(F.col("time"))
    return df.withColumn("time", opened)


def prepare_bars(df: DataFrame, arrival: Sequence[str] = ("ingest_seq",)) -> DataFrame:
    """Time, duplicates and columns put right; ready for the gate.

    Times are normalised before duplicates are sought, so that one instant in two
    spellings is one bar, and moved to the opening hour after, so that no bar takes
    another's place. Rows without a time all stay, for the gate to name. A frame without arrival columns, such as one just made
    from a list, arrives in the order of its rows.
    """
    known = [name for name in arrival if name in df.columns]
    if not known:
        known = ["ingest_seq"]
        df = df.withColumn("ingest_seq", F.monotonically_increasing_id())
    timed = conform(normalize_time(df), keep=tuple(known))
    return open_daily_bars(keep_last(timed, known)).drop(*known)


def finish_bars(
    good: DataFrame,
    roots: Sequence[str] | None = C.SPLICED_ROOTS,
    gap_basis: str = "close",
) -> DataFrame:
    """After the gate: volumes filled, contracts spliced, incomplete rows dropped."""
    timed = fill_volumes(good).where(F.col("time").isNotNull())
    return drop_incomplete(splice_series(timed, gap_basis, roots))


def clean_bars(
    raw: Any,
    symbol: str | None = None,
    strict: bool = False,
    arrival: Sequence[str] = ("ingest_seq",),
    roots: Sequence[str] | None = C.SPLICED_ROOTS,
    gap_basis: str = "close",
) -> DataFrame:
    """The whole cleaning of any number of series in one frame.

    ``raw`` is a Spark frame, a pandas frame or a list of rows; ``symbol`` names
    the series where the rows do not. No rows give an empty frame.

    ``strict`` raises at the first bad bar; otherwise bad bars are left out. The
    prepared bars are staged, so that times are parsed and duplicates sought once
    for the gate, the rollover search and the bars themselves.
    """
    if not isinstance(raw, DataFrame):
        session = SparkSession.active()
        if not len(raw):
            return session.createDataFrame([], SILVER)
        raw = as_frame(session, raw)
    if symbol is not None:
        raw = raw.withColumn("symbol", F.lit(symbol))
    prepared = stage(prepare_bars(raw, arrival), "prepared-bars")
    if strict:
        require_valid(prepared)
    return finish_bars(split_bars(prepared)[0], roots, gap_basis)


def build_silver(
    spark: SparkSession,
    base: str,
    data_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
    strict: bool = True,
    d: float = C.FRAC_ORDER,
    roots: Sequence[str] | None = C.SPLICED_ROOTS,
) -> str:
    """Bronze to silver for all series, or those named.

    Deduplicated bars are staged once; the gate, the slicing by measured row
    counts, the splice and the write then read only their columns of them. Bad bars
    go to the quarantine dataset with a reason, before prices are spliced, so that
    none spreads to its neighbours. With ``strict`` a series with a bar that breaks a
    price rule is held: its silver rows stay as they were, other series are written.
    If all are held, ``DataQualityError`` is raised. A series without any row left
    loses its old files.
    """
    bronze = read_layer(spark, base, "bronze", data_type, symbol, timeframe)
    if bronze.isEmpty():
        raise ValueError(f"no bronze bars in {base}")
    prepared = stage(prepare_bars(bronze, ("batch_id", "ingest_seq")), "prepared-bars")
    verdicts = stage(series_verdicts(prepared), "verdicts")
    good, bad = split_bars(prepared)
    seen = verdicts.select(*KEY)
    replace_series(by_range(bad), base, "quarantine", seen)
    if strict and verdicts.where("held").take(1):
        held = verdicts.where("held").select(*KEY)
        seen = verdicts.where("not held").select(*KEY)
        shown = held.take(C.SAMPLE_ROWS)
        if not seen.take(1):
            raise DataQualityError(f"every series has bars that break a price rule: {shown}")
        log.error("series held back for bars that break a price rule, for example %s", shown)
        good = good.join(seen, on_key(good, seen), "left_semi")
    bars = keep_finite(finish_bars(balanced_slices(good), roots))
    return replace_series(fractional_difference(bars, "close", d), base, "silver", seen)
