"""All layers in sequence: one Spark job per layer for every series at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.plans.gold import build_gold, check_gold
from barloom.plans.silver import build_silver
from barloom.schemas import KEY
from barloom.sources.bronze import append_bars, as_frame
from barloom.sources.layers import listed_series

DEFAULT_TIMEFRAME = "M5"


def _many_series(spark: SparkSession, by_symbol: dict[str, Any]) -> DataFrame:
    frames = [as_frame(spark, raw).withColumn("symbol", F.lit(s)) for s, raw in by_symbol.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def run_layers(
    spark: SparkSession,
    base: str,
    raw: DataFrame | dict[str, Any],
    symbols: Sequence[str] | None = None,
    timeframe: str = DEFAULT_TIMEFRAME,
    data_type: str | None = None,
    strict: bool = True,
    d: float = C.FRAC_ORDER,
    roots: Sequence[str] | None = C.SPLICED_ROOTS,
) -> DataFrame:
    """Bronze, silver, gold and quality report; returns one row per series.

    ``raw`` is a frame with a ``symbol`` column, or rows by symbol. ``symbols`` says
    which symbols the caller expects: other ones in ``raw``, or missing ones, are an
    error.
    """
    if not isinstance(raw, DataFrame):
        raw = {symbol: rows for symbol, rows in raw.items() if len(rows)}
        found = set(raw)
        if not raw:
            raise ValueError("no bars given")
        raw = _many_series(spark, raw)
    elif symbols is not None:
        found = {row["symbol"] for row in raw.select("symbol").distinct().collect()}
    if symbols is not None and found != set(symbols):
        raise ValueError(f"symbols without bars or not expected: {sorted(found ^ set(symbols))}")
    frame_label = None if "timeframe" in raw.columns else timeframe
    if not append_bars(spark, base, raw, None, frame_label, data_type):
        raise RuntimeError("bronze ingest failed")
    build_silver(spark, base, strict=strict, d=d, roots=roots)
    build_gold(spark, base)
    return layers_report(spark, base, strict)


def layers_report(spark: SparkSession, base: str, strict: bool = True) -> DataFrame:
    """Which layers hold rows of a series, from their files, and the verdict on its gold rows."""
    held = [
        listed_series(spark, base, layer).withColumn(layer, F.lit(True)) for layer in ("bronze", "silver", "gold")
    ]
    checks = check_gold(spark, base, strict=strict).select(*KEY, "is_valid", "validated_rows")
    joined = reduce(lambda a, b: a.join(b, [*KEY], "left"), [*held, checks])
    return joined.na.fill(False, ["bronze", "silver", "gold"]).na.fill(0, ["validated_rows"])
