"""Ordered work on long series without putting one series into one task.

Window functions partitioned by symbol would send a symbol that owns a third
of all rows to a single task. Here each series is cut into time slices, and
each slice receives copies of the last rows before it, so that row-count
frames (``lag``, the last 10 rows, the last 101 rows) see exactly what they
would see in the whole series. Slices are a function of the row's time alone:
no sample, no partition number, and a lost task recomputes the same slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.times import DEFAULT_STEP_SECONDS, micros, step_seconds_of
from barloom.schemas import series_key
from barloom.sources.layers import stage

SLICE = "_slice"
COPIED = "_copied"

SLICE_ROWS = 1 << 20


def time_slices(
    df: DataFrame, time: str = "time", step_seconds: float | None = None, rows: int = SLICE_ROWS
) -> DataFrame:
    """Add the slice, named by its first microsecond, to every row.

    A slice spans ``rows`` bars of the series' own timeframe, so a slice of
    aligned, distinct bars holds at most ``rows`` of them. ``balanced_slices``
    is for rows that keep to no timeframe.
    """
    if step_seconds is None and "timeframe" in df.columns:
        step = step_seconds_of(F.col("timeframe"))
    else:
        step = F.lit(DEFAULT_STEP_SECONDS if step_seconds is None else step_seconds)
    width = F.greatest((step * F.lit(rows * 1e6)).cast("bigint"), F.lit(1).cast("bigint"))
    at = micros(F.col(time))
    return df.withColumn(SLICE, at - F.pmod(at, width))


def balanced_slices(
    df: DataFrame,
    time: str = "time",
    keys: Sequence[str] | None = None,
    limit: int = SLICE_ROWS,
    width_seconds: int = 1 << 30,
) -> DataFrame:
    """Slices by measured row counts: any that exceeds ``limit`` is cut further.

    Each round counts rows per slice (a pre-aggregated pass over key and time)
    and narrows only the overfull slices; the rounds end when none is left, at
    the latest at a width of one microsecond. The table of overfull slices has
    at most rows / ``limit`` entries; it is written, and Spark broadcasts it
    only while its file is below the broadcast threshold.
    """
    keys = list(keys or series_key(df))
    width = "_width"
    at = micros(F.col(time))
    start = at - F.pmod(at, F.col(width))
    sliced = df.withColumn(width, F.lit(width_seconds * 1_000_000).cast("bigint")).withColumn(
        SLICE, start
    )
    while True:
        # half full if the rows lie evenly over the time they occupy
        parts = F.col("_rows") / F.lit(limit) * 2
        narrower = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("_span") / parts))
        overfull = stage(
            sliced.groupBy(*keys, SLICE, width)
            .agg(F.count("*").alias("_rows"), (F.max(at) - F.min(at) + 1).alias("_span"))
            .where((F.col("_rows") > limit) & (F.col(width) > 1))
            .select(*keys, SLICE, width, narrower.alias("_narrower")),
            "overfull-slices",
        )
        if overfull.isEmpty():
            return sliced.drop(width)
        # cells of one width nest in their parent: both count from the parent's start
        offset = at - F.col(SLICE)
        inner = F.col(SLICE) + offset - F.pmod(offset, F.col("_narrower"))
        sliced = (
            sliced.join(overfull, [*keys, SLICE, width], "left")
            .withColumn(SLICE, F.coalesce(inner, F.col(SLICE)))
            .withColumn(width, F.coalesce("_narrower", width))
            .drop("_narrower")
        )


def with_lookback(
    df: DataFrame,
    rows: int,
    keys: Sequence[str] | None = None,
    order: Sequence[str] = ("time",),
) -> DataFrame:
    """Every row, plus copies of the ``rows`` rows that precede each slice.

    Both branches read one shuffle by key and slice. The copies come from the
    last ``rows`` rows of each slice; a slice shorter than that passes on the
    copies of the slices before it, counted by the running row total, however
    many slices back they lie.
    """
    keys = list(keys or series_key(df))
    group = [*keys, SLICE]
    if SLICE not in df.columns:
        df = time_slices(df, order[0])
    payload = [name for name in df.columns if name not in group]
    own = df.repartition(*[F.col(name) for name in group])

    newest_first = Window.partitionBy(*group).orderBy(*[F.desc(name) for name in order])
    tails = (
        own.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= rows)
        .groupBy(*group)
        .agg(
            F.count("*").alias("_held"),
            F.collect_list(F.struct("_rank", *payload)).alias("_rows"),
        )
    )
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    running = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = by_slice.rowsBetween(1, rows)
    targets = tails.withColumn("_upto", F.sum("_held").over(running)).withColumn(
        "_targets",
        F.collect_list(
            F.struct(F.col(SLICE).alias("slice"), (F.col("_upto") - F.col("_held")).alias("before"))
        ).over(following),
    )
    missing = F.lit(rows) - (F.col("_target.before") - F.col("_upto"))
    copies = (
        targets.select(*keys, "_rows", "_upto", F.explode("_targets").alias("_target"))
        .where(missing > 0)
        .select(
            *keys,
            F.col("_target.slice").alias(SLICE),
            missing.alias("_missing"),
            F.explode("_rows").alias("_row"),
        )
        .where(F.col("_row._rank") <= F.col("_missing"))
        .select(*group, *[F.col("_row")[name].alias(name) for name in payload])
        .repartition(*[F.col(name) for name in group])
    )
    return own.withColumn(COPIED, F.lit(False)).unionByName(
        copies.withColumn(COPIED, F.lit(True))
    )


def over_series(
    df: DataFrame,
    rows: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    keys: Sequence[str] | None = None,
    order: Sequence[str] = ("time",),
) -> DataFrame:
    """Apply ``build(frame, window)`` to each whole series, slice by slice.

    ``build`` may look back ``rows`` rows at most; copies are removed after it.
    """
    keys = list(keys or series_key(df))
    kept = [SLICE] if SLICE in df.columns else []
    sliced = with_lookback(df, rows, keys, order)
    window = Window.partitionBy(*keys, SLICE).orderBy(*order)
    built = build(sliced, window).where(~F.col(COPIED)).drop(COPIED)
    return built if kept else built.drop(SLICE)
