"""A perpetual series from overlapping contracts: front and next by expiry, weighted by activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.contracts import decode, dollar_expiry, index_expiry
from barloom.operators.asof import asof_join
from barloom.schemas import PRICES

INDEX_ROOT = "WIN"


def contract_month(code: Column) -> Column:
    """The first day of the month that a code names, in this century."""
    parts = decode(code)
    return F.make_date(parts["year"], parts["month"], F.lit(1))


def contract_calendar(contracts: DataFrame) -> DataFrame:
    """(root, contract, following, time): contracts by their last day, each with the one after it.

    ``contracts`` has a column ``contract`` and, where codes are of another century, the
    ``month``. ``WIN`` contracts end by the index rule, others by the dollar rule; codes
    without such a day are left out. The table has a row a contract, so a window over a
    root is short.
    """
    month = F.col("month") if "month" in contracts.columns else contract_month(F.col("contract"))
    root = F.substring("contract", 1, 3)
    last = F.when(root == INDEX_ROOT, index_expiry(month)).otherwise(dollar_expiry(month))
    known = contracts.select("contract", root.alias("root"), last.cast("timestamp_ntz").alias("time")).distinct()
    by_expiry = Window.partitionBy("root").orderBy("time", "contract")
    return known.where("time is not null").select(
        "root", "contract", F.lead("contract").over(by_expiry).alias("following"), "time"
    )


def perpetual_chain(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per root and time: front and next contract mixed by their activity.

    ``bars`` has root, contract, time, prices, tick_volume and, if known, open_interest. At
    any time the front is the contract of the next expiry (that day included) and the other
    one follows it; bars of further contracts don't count. Activity is volume plus open
    interest, and the front's weight is its share of both contracts' activity. Once the
    following contract is ahead the roll doesn't flip back: from there on the weight never
    rises until the front expires. A contract without a bar has no weight; where neither
    has activity, the front has all.

    One shuffle brings the two bars of a time together; the scan runs within the life of a
    front, so it holds one contract's bars.
    """
    interest = F.col("open_interest") if "open_interest" in bars.columns else F.lit(0)
    activity = (F.coalesce("tick_volume", F.lit(0)) + F.coalesce(interest, F.lit(0))).cast("double")
    narrow = bars.select("root", "contract", "time", *PRICES, "tick_volume", activity.alias("_activity"))
    names = calendar.select("root", "time", F.col("contract").alias("front"), "following")
    placed = asof_join(narrow, names, ["front", "following"], keys=["root"], direction="forward")
    sides = {"a": F.col("contract") == F.col("front"), "b": F.col("contract") == F.col("following")}
    values = [*PRICES, "tick_volume", "_activity"]
    both = placed.where(sides["a"] | sides["b"]).groupBy("root", "time", "front", "following").agg(
        *[F.max(F.when(on, F.col(name))).alias(f"{side}_{name}") for side, on in sides.items() for name in values]
    )

    def mixed(name: str) -> Column:
        a, b = F.col(f"a_{name}"), F.col(f"b_{name}")
        sum_ = F.col("front_weight") * F.coalesce(a, F.lit(0.0)) + (1 - F.col("front_weight")) * F.coalesce(b, F.lit(0.0))
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(sum_).alias(name)

    a, b = F.col("a__activity"), F.col("b__activity")
    share = F.when(b.isNull(), 1.0).when(a.isNull(), 0.0).otherwise(F.coalesce(F.try_divide(a, a + b), F.lit(1.0)))
    so_far = Window.partitionBy("root", "front").orderBy("time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = F.max(F.col("_share") < 0.5).over(so_far)
    least = F.min(F.when(F.col("rolled"), F.col("_share"))).over(so_far)
    weighed = (
        both.withColumn("_share", share)
        .withColumn("rolled", rolled)
        .withColumn("front_weight", F.coalesce(least, F.col("_share")))
    )
    volume = F.coalesce("a_tick_volume", F.lit(0)) + F.coalesce("b_tick_volume", F.lit(0))
    return weighed.select(
        "root", "time", "front", "following", "front_weight", "rolled", *map(mixed, PRICES), volume.alias("tick_volume")
    )
