"""One continuous series from expiring contracts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.operators.asof import asof_join
from barloom.operators.series import COPIED, SLICE, over_series, time_slices, with_lookback
from barloom.schemas import CONTRACT, PRICES, series_key
from barloom.sources.layers import stage


def is_spliced(symbol: Column, roots: Sequence[str] | None = C.SPLICED_ROOTS) -> Column:
    """Whether a symbol names a series to splice; ``roots=None`` takes all symbols."""
    if roots is None:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [symbol.contains(root) for root in roots], F.lit(False))


def _gap(window, basis: str) -> Column:
    """At a change of contract the step to the new price level, else 0.

    A missing contract on either side is no change.
    """
    changed = F.coalesce(F.col(CONTRACT) != F.lag(CONTRACT).over(window), F.lit(False))
    step = F.col(basis) - F.lag("close").over(window)
    return F.coalesce(F.when(changed, step), F.lit(0.0))


def rollovers(
    df: DataFrame, gap_basis: str = "close", roots: Sequence[str] | None = C.SPLICED_ROOTS
) -> DataFrame:
    """The bars at which the contract changes, with the gap; reads four columns only."""
    keys = series_key(df)
    cut = [SLICE] if SLICE in df.columns else []
    needed = dict.fromkeys([*keys, *cut, "time", CONTRACT, "close", gap_basis])
    narrow = df.select(*needed).where(is_spliced(F.col("symbol"), roots))
    return (
        over_series(narrow, 1, lambda s, w: s.withColumn("gap", _gap(w, gap_basis)))
        .where(F.col("gap") != 0)
        .select(*keys, "time", "gap")
    )


def _shifted(df: DataFrame, offset: Column) -> DataFrame:
    return df.withColumns({name: F.col(name) + offset for name in PRICES})


def splice_series(
    df: DataFrame, gap_basis: str = "close", roots: Sequence[str] | None = C.SPLICED_ROOTS
) -> DataFrame:
    """Add to each bar the sum of all gaps after it, for any number of rollovers.

    The sum has two levels: within the slice a running sum from the newest bar,
    and a table of slice totals for all later slices, joined on the partitioning
    the bars already have. The totals come from a second, narrow reading of the
    bars: stage them first if they are costly to compute.
    """
    if CONTRACT not in df.columns:
        return df
    keys = series_key(df)
    group = [*keys, SLICE]
    kept = [name for name in df.columns if name != CONTRACT]
    sliced = df if SLICE in df.columns else time_slices(df)
    in_time = Window.partitionBy(*group).orderBy("time")

    def gaps(frame: DataFrame) -> DataFrame:
        marked = F.when(is_spliced(F.col("symbol"), roots), _gap(in_time, gap_basis)).otherwise(0.0)
        return with_lookback(frame, 1).withColumn("_gap", marked).where(~F.col(COPIED)).drop(COPIED)

    needed = dict.fromkeys([*group, "time", CONTRACT, "close", gap_basis])
    newer_slices = (
        Window.partitionBy(*keys)
        .orderBy(F.desc(SLICE))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    later = (
        gaps(sliced.select(*needed))
        .groupBy(*group)
        .agg(F.sum("_gap").alias("_total"))
        .select(*group, F.coalesce(F.sum("_total").over(newer_slices), F.lit(0.0)).alias("_later"))
    )
    newer_bars = (
        Window.partitionBy(*group)
        .orderBy(F.desc("time"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = gaps(sliced).withColumn(
        "_within", F.coalesce(F.sum("_gap").over(newer_bars), F.lit(0.0))
    )
    same = reduce(lambda a, b: a & b, [F.col(f"w.{k}").eqNullSafe(F.col(f"l.{k}")) for k in group])
    joined = within.alias("w").join(later.alias("l"), same, "left").select("w.*", "_later")
    offset = F.coalesce("_later", F.lit(0.0)) + F.col("_within")
    return _shifted(joined, offset).select(*kept)


def splice_broadcast(
    df: DataFrame,
    gap_basis: str = "close",
    roots: Sequence[str] | None = C.SPLICED_ROOTS,
) -> DataFrame:
    """The same result from the table of periods between rollovers.

    Between two rollovers the offset is constant. The periods are written to the work
    folder, and Spark broadcasts them while their file is below its threshold. Each bar
    is compared with the periods of its series: this form is for few rollovers, and the
    layers use ``splice_series``.
    """
    if CONTRACT not in df.columns:
        return df
    keys = series_key(df)
    marks = rollovers(df, gap_basis, roots)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("time"))
    in_time = Window.partitionBy(*keys).orderBy("time")
    periods = (
        marks.withColumn("_offset", F.sum("gap").over(newest_first))
        .select(
            *keys,
            F.lag("time").over(in_time).alias("_from"),
            F.col("time").alias("_until"),
            "_offset",
        )
    )
    bars, period = df.alias("bars"), stage(periods, "periods").alias("period")
    same = reduce(
        lambda a, b: a & b, [F.col(f"bars.{k}").eqNullSafe(F.col(f"period.{k}")) for k in keys]
    )
    inside = (F.col("bars.time") < F.col("_until")) & (
        F.col("_from").isNull() | (F.col("bars.time") >= F.col("_from"))
    )
    joined = bars.join(period, same & inside, "left").select("bars.*", "_offset")
    kept = [name for name in df.columns if name != CONTRACT]
    return _shifted(joined, F.coalesce("_offset", F.lit(0.0))).select(*kept)


def gap_ledger(
    df: DataFrame, gap_basis: str = "close", roots: Sequence[str] | None = C.SPLICED_ROOTS
) -> DataFrame:
    """Per series and rollover the sum of its gap and all later ones: a row for each rollover.

    Bars keep the prices of their own contract; a further rollover changes this table only.
    """
    marks = rollovers(df, gap_basis, roots)
    keys = series_key(marks)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("time"))
    return marks.select(*keys, "time", F.sum("gap").over(newest_first).alias("later_gaps"))


def splice_asof(df: DataFrame, ledger: DataFrame, **how) -> DataFrame:
    """Bars shifted by the ledger: each by the entry of the first rollover after it, if any."""
    joined = asof_join(df, ledger, ["later_gaps"], direction="forward", equal=False, **how)
    kept = [name for name in df.columns if name != CONTRACT]
    return _shifted(joined, F.coalesce("later_gaps", F.lit(0.0))).select(*kept)


def perpetual_roll(
    front: DataFrame, following: DataFrame, on: Sequence[str] = ("root", "time"), how: str = "inner"
) -> DataFrame:
    """Volume-weighted mean of two contracts at equal times.

    The weight of the front contract is its share of the traded volume. Where
    only one contract has a bar (``how="outer"``), it stands alone.
    """
    volume_a, volume_b = F.col("a.tick_volume"), F.col("b.tick_volume")
    share = F.coalesce(
        F.when(volume_b.isNull(), F.lit(1.0)).when(volume_a.isNull(), F.lit(0.0)),
        F.try_divide(volume_a, volume_a + volume_b),
        F.lit(1.0),
    )
    condition = reduce(lambda a, b: a & b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on])
    joined = front.alias("a").join(following.alias("b"), condition, how)
    return joined.withColumn("front_weight", share).select(
        *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in on],
        "front_weight",
        *[
            (
                F.col("front_weight") * F.coalesce(f"a.{p}", F.lit(0.0))
                + (1 - F.col("front_weight")) * F.coalesce(f"b.{p}", F.lit(0.0))
            ).alias(p)
            for p in PRICES
        ],
        (F.coalesce(volume_a, F.lit(0)) + F.coalesce(volume_b, F.lit(0))).alias("tick_volume"),
    )
