"""Model drift audit over a table of metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions.checks import is_degraded

ALERT_TITLE = "Sharpe ratio below its limit"


def drift_audit(metrics: DataFrame, least: float = C.MIN_SHARPE) -> DataFrame:
    """All metric rows; those whose Sharpe ratio is missing or too low have a title.

    All other columns of the audit go along as JSON in ``metrics``.
    """
    rest = [name for name in metrics.columns if name not in ("model", "ts", "sharpe_ratio")]
    payload = F.to_json(F.struct(*rest)) if rest else F.lit(None).cast("string")
    return metrics.select(
        "model",
        "ts",
        "sharpe_ratio",
        F.when(is_degraded(F.col("sharpe_ratio"), least), ALERT_TITLE).alias("title"),
        payload.alias("metrics"),
        F.to_date("ts").alias("alert_date"),
    )


def drift_alerts(metrics: DataFrame, least: float = C.MIN_SHARPE) -> DataFrame:
    """Metric rows whose Sharpe ratio is missing or too low, as alerts."""
    return drift_audit(metrics, least).where("title is not null")
