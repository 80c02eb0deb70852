"""Layers kept up to date: only what new bronze files touch is built again.

A run takes the bronze files that no run has built. Their rows name the touched series
and, in each, the time range (``period``) from which bars may differ. From there on bars
are cleaned again, in the prices of their own contract (layer ``clean``), and the table of
rollovers (layer ``ledger``) is made anew. Silver and gold are computed from the same
range on, with the ranges before it that hold the look-back, or from the first bar where
the ledger changed, as a rollover shifts all older prices. Only those ranges are written.

Bars that break a rule go to the quarantine and hold no other bar. The list of built files
is written last: a run that failed is done again and replaces what it had written. One
run at a time.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions.times import micros
from barloom.operators.conform import drop_incomplete, fill_volumes, keep_finite
from barloom.operators.features import technical_features
from barloom.operators.fracdiff import fractional_difference
from barloom.operators.quality import split_bars
from barloom.operators.series import balanced_slices
from barloom.operators.splice import gap_ledger, splice_asof
from barloom.plans.silver import normalize_time, prepare_bars
from barloom.schemas import KEY, PERIOD, TIME_AT, on_key
from barloom.sources.layers import (
    by_range, layer_files, layer_path, period_of, read_files, read_layer, replace_series, stage,
)

log = logging.getLogger(__name__)

#: Rows before a range that its features and differences may need.
LOOKBACK = max(C.FRAC_MAX_LAG, C.ROLLING_ROWS) + 1
DAY = 86_400_000_000
NEVER = 1 << 62


def _built_files(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema("path string").parquet(layer_path(base, "built"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")


def _on_series(df: DataFrame, series: DataFrame, condition: Column | None = None) -> DataFrame:
    """Rows of the series in a table of one row for each."""
    same = on_key(df, series)
    return df.join(series, same if condition is None else same & condition, "left_semi")


def touched_series(fresh: DataFrame) -> DataFrame:
    """Per series of new rows the range from which bars may differ; without any time, none."""
    timed = normalize_time(fresh.select(*KEY, "time", TIME_AT))
    first = period_of(F.col("time"), F.col("timeframe"))
    return timed.groupBy(*KEY).agg(F.coalesce(F.min(first), F.lit(NEVER)).alias("since"))


def _from(since: str = "since", earlier: int = 0) -> Column:
    """Whether a row lies in the ranges to build; one without time always does."""
    return F.col("time").isNull() | F.col(since).isNull() | (micros(F.col("time")) >= F.col(since) - earlier)


def _clean(spark: SparkSession, base: str, touched: DataFrame) -> None:
    """Clean bars and quarantine of the touched ranges."""
    bronze = read_files(spark, base, "bronze", _on_series(layer_files(spark, base, "bronze"), touched))
    # a bar of a day may still move to the opening hour, and so into the first range
    rows = _on_series(normalize_time(bronze), touched, _from(earlier=DAY))
    prepared = stage(prepare_bars(rows, ("batch_id", "ingest_seq")), "prepared-bars")
    good, bad = split_bars(_on_series(prepared, touched, _from()))
    replace_series(by_range(bad), base, "quarantine", touched)
    replace_series(by_range(keep_finite(drop_incomplete(fill_volumes(good)))), base, "clean", touched)


def _ledger(
    spark: SparkSession, base: str, touched: DataFrame, gap_basis: str, roots: Sequence[str] | None
) -> tuple[DataFrame, DataFrame]:
    """The touched series' ledger, written anew, and the series whose ledger changed."""
    bars = read_files(spark, base, "clean", _on_series(layer_files(spark, base, "clean"), touched))
    new = stage(gap_ledger(bars, gap_basis, roots), "ledger")
    old = _on_series(read_layer(spark, base, "ledger"), touched)
    names = [*KEY, "time", "later_gaps"]
    both = new.select(*names, F.lit(1).alias("n")).unionByName(old.select(*names, F.lit(-1).alias("n")))
    differ = both.groupBy(*names).agg(F.sum("n").alias("n")).where("n <> 0")
    changed = stage(differ.select(*KEY).distinct(), "changed")
    replace_series(new, base, "ledger", touched.select(*KEY))
    return new, changed


def _with_lookback(spark: SparkSession, base: str, starts: DataFrame) -> DataFrame:
    """Clean bars of the ranges to build and of those before them that hold the look-back."""
    files = stage(_on_series(layer_files(spark, base, "clean"), starts), "files")
    rows = read_files(spark, base, "clean", files, ranged=True)
    counted = rows.groupBy(*KEY, PERIOD).agg(F.count("*").alias("rows"))
    counts = counted.join(starts, on_key(counted, starts)).select(
        *[counted[name] for name in (*KEY, PERIOD, "rows")], "since"
    )
    late = F.col("since").isNull() | (F.col(PERIOD) >= F.col("since"))
    newer = Window.partitionBy(*KEY).orderBy(F.desc(PERIOD)).rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum(F.when(~late, F.col("rows")).otherwise(0)).over(newer), F.lit(0))
    needed = stage(counts.withColumn("_held", held).where(late | (F.col("_held") < LOOKBACK)), "ranges")
    chosen = files.join(needed, on_key(files, needed) & (files[PERIOD] == needed[PERIOD]), "left_semi")
    return read_files(spark, base, "clean", chosen)


def update_layers(
    spark: SparkSession,
    base: str,
    d: float = C.FRAC_ORDER,
    roots: Sequence[str] | None = C.SPLICED_ROOTS,
    gap_basis: str = "close",
) -> DataFrame:
    """Bring silver and gold up to the bronze files there are.

    Returns the touched series, with the start of the first range that was built (in
    microseconds, null for the whole series). The layers hold what a build of everything
    would give.
    """
    listed = layer_files(spark, base, "bronze")
    new = stage(listed.join(_built_files(spark, base), "path", "left_anti"), "new-files")
    if new.isEmpty():
        log.info("no new files in %s", base)
        return new.select(*KEY, F.lit(None).cast("bigint").alias("since"))
    touched = stage(touched_series(read_files(spark, base, "bronze", new)), "touched")
    _clean(spark, base, touched)
    ledger, changed = _ledger(spark, base, touched, gap_basis, roots)
    mark = changed.withColumn("_changed", F.lit(True))
    starts = touched.join(mark, on_key(touched, mark), "left").select(
        *[touched[name] for name in KEY], F.when(F.col("_changed").isNull(), F.col("since")).alias("since")
    )
    starts = stage(starts, "starts")
    bars = stage(splice_asof(_with_lookback(spark, base, starts), ledger), "adjusted-bars")
    silver = stage(fractional_difference(balanced_slices(bars), "close", d).drop("_slice"), "silver-rows")
    replace_series(_on_series(silver, starts, _from()), base, "silver", starts)
    gold = technical_features(balanced_slices(silver)).drop("_slice")
    replace_series(_on_series(gold, starts, _from()), base, "gold", starts)
    new.select("path").write.mode("append").parquet(layer_path(base, "built"))
    return starts
