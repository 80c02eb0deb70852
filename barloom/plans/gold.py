"""From clean bars to features, and the closing quality report."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.operators.features import technical_features
from barloom.operators.quality import DataQualityError, quality_report
from barloom.operators.series import balanced_slices
from barloom.schemas import KEY
from barloom.sources.layers import listed_series, read_layer, replace_series, stage

log = logging.getLogger(__name__)


def _named(**wanted: str | None) -> Column:
    conditions = [F.col(name) == value for name, value in wanted.items() if value is not None]
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def build_gold(
    spark: SparkSession,
    base: str,
    data_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
) -> str:
    """Silver to gold for all series, or those named; a series gone from silver goes from gold."""
    silver = read_layer(spark, base, "silver", data_type, symbol, timeframe)
    wanted = {"data_type": data_type, "symbol": symbol, "timeframe": timeframe}
    known = listed_series(spark, base, "silver").unionByName(listed_series(spark, base, "gold"))
    seen = stage(known.where(_named(**wanted)).distinct(), "series")
    if seen.isEmpty():
        raise ValueError(f"no silver bars in {base}")
    return replace_series(technical_features(balanced_slices(silver)), base, "gold", seen)


def check_gold(
    spark: SparkSession,
    base: str,
    data_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Validity and row count of each gold series, from one scan.

    ``strict`` raises if no series is valid, and logs those that are not.
    """
    gold = read_layer(spark, base, "gold", data_type, symbol, timeframe)
    report = stage(quality_report(gold), "report")
    bad = report.where("not is_valid")
    if strict and (shown := bad.select(*KEY, "violations").take(C.SAMPLE_ROWS)):
        if report.where("is_valid").isEmpty():
            raise DataQualityError(f"no gold series is valid: {shown}")
        log.error("gold series with bars that break a price rule, for example %s", shown)
    return report
