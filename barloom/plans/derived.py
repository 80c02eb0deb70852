"""Bars, ticks and metrics derived from the provided tables.

The tables hold no market bars. Every frame here reads whole tables; the SQL
definitions in ``oracles`` are the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.contracts import encode
from barloom.functions.times import truncated
from barloom.operators.asof import asof_join
from barloom.operators.bars import arrival_order, ohlc_aggregates, ohlc_bars
from barloom.operators.dedup import keep_last
from barloom.schemas import CONTRACT

#: Least arrival number of a bar that was sent again.
SENT_AGAIN = 1_000_000_000
PRICE_COLUMNS = ("open", "high", "low", "close")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars, one series per event type."""
    return ohlc_bars(table(spark, sf_dir, "events"))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of line item prices, one series per supplier."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("supplier"),
        "l_shipdate",
        "l_extendedprice",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"),
    )
    found = ohlc_bars(lines, "day", "supplier", "l_shipdate", "l_extendedprice", "line")
    return found.withColumn("timeframe", F.lit("D1"))


def ticks_as_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time as one row of its type's series; the last event at a time counts."""
    ticks = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("time"),
        "event_id",
        F.col("value").alias("close"),
    )
    return keep_last(ticks, ["event_id"]).drop("event_id")


def contracts(frame: DataFrame) -> DataFrame:
    """Two rollovers per series: on 11 and 21 January."""
    day = F.to_date("time")
    return frame.withColumn(
        CONTRACT,
        F.when(day < F.lit("2024-01-11").cast("date"), "WINF24")
        .when(day < F.lit("2024-01-21").cast("date"), "WING24")
        .otherwise("WINH24"),
    )


def _defect_number() -> Column:
    return F.dayofmonth("time") + F.hour("time")


def defects(frame: DataFrame) -> DataFrame:
    """Some bars with high below low, some without close."""
    n = _defect_number()
    return frame.withColumns(
        {
            "high": F.when(n % 11 == 0, F.col("low") - 1).otherwise(F.col("high")),
            "close": F.when(n % 13 != 1, F.col("close")),
        }
    )


def non_finite(frame: DataFrame) -> DataFrame:
    n = _defect_number()
    return frame.withColumn(
        "close",
        F.when(n % 7 == 0, F.lit(float("inf")))
        .when(n % 7 == 1, F.lit(float("nan")))
        .when(n % 7 != 2, F.col("close")),
    )


def duplicates(frame: DataFrame) -> DataFrame:
    """Bars at even hours are sent again, with another close; arrival numbers are distinct."""
    arrival = F.floor(F.unix_seconds(F.col("time").cast("timestamp")) / 3600)
    first = frame.withColumn("ingest_seq", arrival)
    again = frame.where(F.hour("time") % 2 == 0).withColumns(
        {"close": F.col("close") + 1, "ingest_seq": F.lit(SENT_AGAIN) + arrival}
    )
    return first.unionByName(again)


def as_text(time: Column) -> Column:
    """The time in one of three layouts, or as a date, by the hour."""
    kind = F.hour(time) % 4
    return (
        F.when(kind == 0, F.concat(F.date_format(time, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(kind == 1, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.date_format(time, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(time, "yyyy-MM-dd"))
    )


def continuous_symbols(frame: DataFrame) -> DataFrame:
    """Two of the series take the names of continuous futures."""
    symbol = F.col("symbol")
    return frame.withColumn(
        "symbol",
        F.when(symbol == "click", "WIN$").when(symbol == "view", "WDO$").otherwise(symbol),
    )


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that can be wrong with bronze bars, in one frame."""
    frame = duplicates(defects(contracts(continuous_symbols(bars(spark, sf_dir)))))
    return frame.withColumns({"time": as_text(F.col("time")), "timeframe": F.lit("H1")})


def as_tick_batches(events: DataFrame) -> DataFrame:
    """Fifty events to a batch; the stated arrival lags by 0 to 19 ms."""
    batch = F.floor(F.col("event_id") / 50)
    sent = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.lit("futures").alias("data_type"),
        F.col("event_type").alias("symbol"),
        F.lit("ticks").alias("timeframe"),
        "event_id",
        batch.alias("batch_id"),
        F.col("event_id").alias("ingest_seq"),
        sent.alias("time_msc"),
        (sent + batch % 20).alias("arrival_msc"),
        "value",
    )


def tick_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_tick_batches(table(spark, sf_dir, "events"))


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and hour the ratio of mean to deviation; null for one event."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("model"), hour.alias("ts"))
        .agg(F.try_divide(F.avg("value"), F.stddev_samp("value")).alias("sharpe_ratio"))
    )


def order_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a trade in the contract of its month."""
    root = F.when(F.col("o_orderkey") % 2 == 0, "WIN").otherwise("WDO")
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("traded"),
        encode(root, F.col("o_orderdate")).alias("contract"),
    )


def contract_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of both roots for every month of the orders, and half a year more."""
    days = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    last = F.add_months(F.trunc("last", "month"), 6)
    months = days.select(F.explode(F.sequence(F.trunc("first", "month"), last, F.expr("interval 1 month"))).alias("month"))
    roots = F.explode(F.array(F.lit("WIN"), F.lit("WDO"))).alias("root")
    return months.select(roots, "month").select(
        encode(F.col("root"), F.col("month")).alias("contract"), F.to_date("month").alias("month")
    )


def contract_bars(spark: SparkSession, sf_dir: str, calendar: DataFrame) -> DataFrame:
    """Weekly bars of orders: each trades in the front contract, some in the one after it.

    The share that trades ahead grows from month's end to month's end, so it wavers around
    the roll.
    """
    ahead = F.pmod(F.col("o_orderkey") * 7, F.lit(31)) < F.dayofmonth("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 2 == 0, "WIN").otherwise("WDO").alias("root"),
        F.col("o_orderdate").alias("time"),
        ahead.alias("ahead"),
        "o_orderkey",
        "o_totalprice",
        (F.col("o_custkey") % 10).alias("opened"),
    )
    named = asof_join(
        orders, calendar, ["contract", "following"], keys=["root"], direction="forward"
    ).withColumn("contract", F.when(F.col("ahead"), F.col("following")).otherwise(F.col("contract")))
    order = arrival_order("time", "o_orderkey")
    return named.groupBy("root", "contract", truncated(F.col("time"), "week").alias("time")).agg(
        *ohlc_aggregates("o_totalprice", order), F.sum("opened").alias("open_interest")
    )
