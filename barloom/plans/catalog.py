"""The registered queries: each operator over whole provided tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions import contracts as codes
from barloom.functions import prices
from barloom.functions.times import normalized_time, session_open
from barloom.operators import chain, conform, dedup, drift, features, quality, splice, ticks
from barloom.operators.fracdiff import (
    fractional_difference,
    least_stationary_order,
    stationarity,
)
from barloom.operators.series import balanced_slices, time_slices
from barloom.plans import derived
from barloom.plans.incremental import update_layers
from barloom.plans.medallion import run_layers
from barloom.plans.silver import build_silver, clean_bars, prepare_bars
from barloom.schemas import FEATURES, KEY
from barloom.session import work_folder
from barloom.sources.bronze import append_bars
from barloom.sources.layers import (
    append_audit,
    period_of,
    read_alerts,
    read_layer,
    replace_series,
    stage,
)
from barloom.streaming import features as live
from barloom.streaming.bars import store_bars, stored_bars, stream_bars
from barloom.streaming.breaker import judge_batches, judged_ticks
from barloom.streaming.ticks import fresh_ticks as read_fresh_ticks
from barloom.streaming.ticks import guard_ticks

Query = Callable[[SparkSession, str], DataFrame]

RANGE_EDGE = datetime(2024, 1, 20)
RANGE_SHOWN = datetime(2024, 1, 15, 12)
ORDER_GRID = tuple(i / 10 for i in range(11))


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _feature(build: Callable[[DataFrame], DataFrame], inputs: Sequence[str], name: str) -> Query:
    """A query that keeps the key and one computed column."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = derived.bars(spark, sf_dir).select("symbol", "time", *inputs)
        return rounded(build(frame).select("symbol", "time", name), name)

    return run


def ohlc_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.bars(spark, sf_dir)


def cyclic_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = features.with_cyclic_time(derived.bars(spark, sf_dir).select("symbol", "time"))
    return rounded(frame, *FEATURES[-8:])


def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.technical_features(derived.bars(spark, sf_dir)), *FEATURES)


def gold_features_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = features.technical_features(derived.daily_bars(spark, sf_dir))
    return rounded(frame.drop("timeframe"), *FEATURES)


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(derived.defects(derived.bars(spark, sf_dir)))


def dq_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.spikes(derived.bars(spark, sf_dir))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(derived.defects(derived.bars(spark, sf_dir)))


def dq_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = derived.defects(derived.bars(spark, sf_dir))
    return quality.samples(frame, quality.violates_ohlcv())


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad, _ = quality.validate(derived.defects(derived.bars(spark, sf_dir)))
    return good.withColumn("accepted", F.lit(True)).unionByName(
        bad.withColumn("accepted", F.lit(False))
    )


def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_last(derived.duplicates(derived.bars(spark, sf_dir)))


def time_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = derived.as_text(F.col("time"))
    frame = derived.bars(spark, sf_dir).select("symbol", text.alias("time_text"))
    return frame.withColumn("time", normalized_time(frame, "time_text"))


def time_from_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    frame = derived.table(spark, sf_dir, "events").select("event_id", seconds.alias("timestamp"))
    return frame.withColumn("time", normalized_time(frame))


def session_open_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = derived.continuous_symbols(derived.bars(spark, sf_dir).select("symbol", "time"))
    return frame.withColumn("opened", session_open(F.col("time"), F.col("symbol")))


def conform_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = F.when(F.hour("time") % 5 != 0, F.col("tick_volume"))
    frame = derived.bars(spark, sf_dir).withColumn("tick_volume", some)
    return conform.fill_volumes(conform.conform(frame))


def drop_null_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = derived.defects(derived.bars(spark, sf_dir))
    late = F.when(F.hour("time") != 23, F.col("time"))
    return conform.drop_incomplete(frame.withColumn("time", late))


def finite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.keep_finite(derived.non_finite(derived.bars(spark, sf_dir)))


def dq_non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.non_finite_counts(derived.non_finite(derived.bars(spark, sf_dir)))


def _spliced(form: Callable[..., DataFrame], gap_basis: str = "close") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = stage(derived.contracts(derived.bars(spark, sf_dir)), "contract-bars")
        return rounded(form(frame, gap_basis, roots=None), *derived.PRICE_COLUMNS)

    return run


def rollover_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = derived.contracts(derived.bars(spark, sf_dir))
    return rounded(splice.rollovers(frame, roots=None), "gap")


def frac_diff_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of 64 hours, shorter than the 100 rows looked back."""
    frame = derived.bars(spark, sf_dir).select("symbol", "time", "close")
    sliced = time_slices(frame, step_seconds=3600, rows=64)
    return rounded(fractional_difference(sliced).drop("_slice", "close"), "frac_diff_close")


def frac_diff_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time is a row of its series; slices follow the measured row counts."""
    ticks = stage(derived.ticks_as_series(spark, sf_dir), "ticks")
    found = fractional_difference(balanced_slices(ticks))
    return rounded(found.select("symbol", "time", "frac_diff_close"), "frac_diff_close")


def frac_diff_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = derived.bars(spark, sf_dir).select("symbol", "time", "close")
    return rounded(stationarity(frame, ORDER_GRID), "t_statistic")


def frac_diff_least_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = derived.bars(spark, sf_dir).select("symbol", "time", "close")
    return least_stationary_order(frame, ORDER_GRID)


def frac_diff_adf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The augmented regressions, with a lagged change where the criterion is for it."""
    frame = derived.bars(spark, sf_dir).select("symbol", "time", "close")
    return rounded(stationarity(frame, ORDER_GRID, lags=1), "t_statistic")


def silver_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_bars(derived.raw_bars(spark, sf_dir))


def series_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.series_verdicts(prepare_bars(derived.raw_bars(spark, sf_dir)))


def layer_row_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each bronze bar went: superseded, quarantined by reason, or silver."""
    base = work_folder(spark, "balance")
    raw = derived.raw_bars(spark, sf_dir)
    append_bars(spark, base, raw, batch_id=1)
    build_silver(spark, base, strict=False)
    bronze = read_layer(spark, base, "bronze")
    prepared = prepare_bars(bronze, ("batch_id", "ingest_seq"))
    refused = read_layer(spark, base, "quarantine")
    reason = F.col("reason")
    counts = [
        bronze.groupBy("symbol").agg(F.count("*").alias("bronze")),
        prepared.groupBy("symbol").agg(F.count("*").alias("prepared")),
        refused.groupBy("symbol").agg(
            F.count_if(reason == "unparsed_time").alias("unparsed_time"),
            F.count_if(reason == "price_rule").alias("price_rule"),
            F.count_if(reason == "not_finite").alias("not_finite"),
            F.count_if(reason == "missing_price").alias("missing_price"),
        ),
        read_layer(spark, base, "silver").groupBy("symbol").agg(F.count("*").alias("silver")),
    ]
    joined = reduce(lambda a, b: a.join(b, "symbol", "left"), counts)
    superseded = (F.col("bronze") - F.col("prepared")).alias("superseded")
    parts = ["unparsed_time", "price_rule", "not_finite", "missing_price", "silver"]
    balanced = F.col("prepared") == reduce(lambda a, b: a + b, map(F.col, parts))
    return joined.select("symbol", "bronze", superseded, *parts, balanced.alias("balanced"))


def layers_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of raw bars, each brought into the layers by itself; silver at the end.

    The second batch brings the last contract, which shifts all older prices, and the bars
    that were sent again. The label cuts a series into ranges of a week.
    """
    base = work_folder(spark, "incremental")
    raw = stage(derived.raw_bars(spark, sf_dir).withColumn("timeframe", F.lit("S5")), "raw-bars")
    late = (F.col("original_contract") == "WINH24") | (F.col("ingest_seq") >= derived.SENT_AGAIN)
    for batch, rows in enumerate((raw.where(~late), raw.where(late)), 1):
        append_bars(spark, base, rows, batch_id=batch)
        update_layers(spark, base)
    silver = read_layer(spark, base, "silver").drop("data_type", "timeframe", "spread", "real_volume")
    return rounded(silver, *derived.PRICE_COLUMNS, "frac_diff_close")


def layer_range_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last ten days of every series replaced, range by range; the days before stay."""
    base = work_folder(spark, "ranges")
    keyed = {"data_type": F.lit("futures"), "timeframe": F.lit("S5")}
    frame = stage(conform.conform(derived.bars(spark, sf_dir)).withColumns(keyed), "bars")
    replace_series(frame, base, "silver")
    edge = period_of(F.lit(RANGE_EDGE).cast("timestamp_ntz"), F.lit("S5"))
    newer = frame.where(period_of(F.col("time"), F.col("timeframe")) >= edge)
    raised = newer.withColumn("close", F.col("close") + 1).where(F.hour("time") % 2 == 0)
    series = frame.select(*KEY).distinct().withColumn("since", edge)
    replace_series(raised, base, "silver", series)
    return read_layer(spark, base, "silver", since=RANGE_SHOWN).select("symbol", "time", "close")


def splice_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = stage(derived.contracts(derived.bars(spark, sf_dir)), "contract-bars")
    found = splice.splice_asof(frame, splice.gap_ledger(frame, roots=None))
    return rounded(found, *derived.PRICE_COLUMNS)


def splice_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of 64 hours, shorter than a contract's life."""
    frame = stage(derived.contracts(derived.bars(spark, sf_dir)), "contract-bars")
    sliced = time_slices(frame, step_seconds=3600, rows=64)
    return rounded(splice.splice_series(sliced, roots=None).drop("_slice"), *derived.PRICE_COLUMNS)


def gold_features_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of 8 hours, shorter than the ten rows looked back."""
    sliced = time_slices(derived.bars(spark, sf_dir), step_seconds=3600, rows=8)
    return rounded(features.technical_features(sliced).drop("_slice"), *FEATURES)


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = fractional_difference(clean_bars(derived.raw_bars(spark, sf_dir)))
    return rounded(frame, *derived.PRICE_COLUMNS, "frac_diff_close")


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended to the bronze dataset, and what a reader finds."""
    base = work_folder(spark, "bronze")
    frame = derived.bars(spark, sf_dir)
    append_bars(spark, base, frame, timeframe="H1", batch_id=1)
    append_bars(spark, base, frame.where(F.hour("time") % 2 == 0), timeframe="H1", batch_id=2)
    return (
        read_layer(spark, base, "bronze", "futures", timeframe="H1")
        .groupBy("data_type", "symbol", "timeframe", "batch_id")
        .agg(F.count("*").alias("rows"), F.sum("tick_volume").alias("tick_volume"))
    )


def layer_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write replaces only the series it holds."""
    base = work_folder(spark, "layer")
    keyed = {"data_type": F.lit("futures"), "timeframe": F.lit("H1")}
    frame = conform.conform(derived.bars(spark, sf_dir)).withColumns(keyed)
    replace_series(frame, base, "silver")
    newer = frame.where(F.col("symbol") == "click").withColumn("close", F.col("close") + 1)
    replace_series(newer, base, "silver")
    return read_layer(spark, base, "silver").select("symbol", "timeframe", "time", "close")


def layers_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of all events through every layer."""
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    raw = derived.duplicates(derived.bars(spark, sf_dir)).withColumn("time", text)
    positive = raw.withColumns({p: F.col(p) + 1 for p in derived.PRICE_COLUMNS}).withColumn(
        "high", F.greatest("high", "close")
    )
    return run_layers(spark, work_folder(spark, "layers"), positive, timeframe="H1")


def stale_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks.stale_batches(derived.tick_batches(spark, sf_dir))


def fresh_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = ticks.flag_stale(derived.tick_batches(spark, sf_dir))
    return flagged.where(~F.col("is_stale")).select("event_id", "batch_id", "time_msc")


def drift_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.drift_alerts(derived.model_metrics(spark, sf_dir))
    return rounded(found.drop("metrics"), "sharpe_ratio")


def drift_alert_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict audit, corrected by a second one; the alerts that stand by day and model."""
    base = work_folder(spark, "alerts")
    metrics = stage(derived.model_metrics(spark, sf_dir), "metrics")
    for least in (2 * C.MIN_SHARPE, C.MIN_SHARPE):
        append_audit(drift.drift_audit(metrics, least), base)
    return read_alerts(spark, base).groupBy("alert_date", "model").agg(F.count("*").alias("alerts"))


def contract_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = derived.order_codes(spark, sf_dir).groupBy("contract").agg(F.count("*").alias("trades"))
    return counted.withColumns(codes.decode(F.col("contract")))


def expiry_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc("traded", "month").alias("month")
    months = derived.order_codes(spark, sf_dir).groupBy(month).agg(F.count("*").alias("trades"))
    return months.withColumns(
        {
            "index_expiry": codes.index_expiry(F.col("month")),
            "dollar_expiry": codes.dollar_expiry(F.col("month")),
        }
    )


def perpetual_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type as a front contract with the type next in order."""
    frame = derived.bars(spark, sf_dir)
    types = frame.select("symbol").distinct()
    pairs = types.withColumn("next", F.lead("symbol").over(Window.orderBy("symbol")))
    front = frame.withColumn("root", F.col("symbol"))
    named = pairs.where("next is not null").select(F.col("symbol").alias("root"), "next")
    following = frame.join(named, F.col("symbol") == F.col("next")).drop("next")
    return rounded(
        splice.perpetual_roll(front, following), "front_weight", *derived.PRICE_COLUMNS
    )


def perpetual_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly contract bars of all orders, front and next by expiry."""
    calendar = stage(chain.contract_calendar(derived.contract_months(spark, sf_dir)), "calendar")
    frame = stage(derived.contract_bars(spark, sf_dir, calendar), "contract-bars")
    found = chain.perpetual_chain(frame, calendar)
    # small volumes give exact halves of the last digit: move them off
    names = ("front_weight", *derived.PRICE_COLUMNS)
    return rounded(found.withColumns({name: F.col(name) + 3e-8 for name in names}), *names)


def _event_stream(spark: SparkSession, sf_dir: str, schema) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


def stream_hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; all bars, those still open at its end included."""
    schema = derived.table(spark, sf_dir, "events").schema
    out = work_folder(spark, "stream-bars")
    bars = stream_bars(_event_stream(spark, sf_dir, schema))
    store_bars(bars, f"{out}/bars", f"{out}/checkpoint", availableNow=True).awaitTermination()
    return stored_bars(spark, f"{out}/bars")


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of all events as a stream in three parts, through features with state."""
    out = work_folder(spark, "stream-features")
    bars = stage(derived.bars(spark, sf_dir), "bars")
    third = F.least(F.floor((F.dayofmonth("time") - 1) / 10), F.lit(2))
    for number in range(3):
        bars.where(third == number).coalesce(1).write.mode("append").parquet(f"{out}/arriving")
    arriving = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/arriving")
    found = live.stream_features(arriving, "0 seconds")
    live.store_features(found, f"{out}/features", f"{out}/checkpoint", availableNow=True).awaitTermination()
    return rounded(live.stored_features(spark, f"{out}/features").drop("frac_diff_close"), *FEATURES)


def stream_fresh_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of tick batches through the breaker."""
    schema = derived.table(spark, sf_dir, "events").schema
    out = work_folder(spark, "stream-ticks")
    stream = derived.as_tick_batches(_event_stream(spark, sf_dir, schema))
    guard_ticks(stream, out, f"{out}/checkpoint", availableNow=True).awaitTermination()
    return read_fresh_ticks(spark, out).select("event_id", "batch_id", "time_msc")


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as tick batches, judged as they close; every tick, dead letters marked."""
    schema = derived.table(spark, sf_dir, "events").schema
    out = work_folder(spark, "stream-breaker")
    stream = derived.as_tick_batches(_event_stream(spark, sf_dir, schema))
    guard_ticks(stream, out, f"{out}/guard", availableNow=True).awaitTermination()
    judge_batches(spark, out, f"{out}/judge", "2 days", "0 seconds", availableNow=True).awaitTermination()
    return judged_ticks(spark, out).select("event_id", "batch_id", "time_msc", "is_stale")


QUERIES: dict[str, Query] = {
    "ohlc_bars": ohlc_bars,
    "log_return": _feature(features.log_return, ["close"], "log_return"),
    "percent_return": _feature(features.percent_return, ["close"], "percent_return"),
    "realized_volatility": _feature(
        features.realized_volatility, ["close"], "realized_volatility"
    ),
    "volume_momentum": _feature(features.volume_momentum, ["tick_volume"], "volume_momentum"),
    "frac_diff_proxy": _feature(features.frac_diff_proxy, ["close"], "frac_diff_proxy"),
    "garman_klass": _feature(
        lambda f: f.withColumn("garman_klass_volatility", prices.garman_klass()),
        derived.PRICE_COLUMNS,
        "garman_klass_volatility",
    ),
    "parkinson": _feature(
        lambda f: f.withColumn("parkinson_volatility", prices.parkinson()),
        ["high", "low"],
        "parkinson_volatility",
    ),
    "order_flow_imbalance": _feature(
        lambda f: f.withColumn("order_flow_imbalance", prices.order_flow_imbalance()),
        [*derived.PRICE_COLUMNS, "tick_volume"],
        "order_flow_imbalance",
    ),
    "cyclic_time": cyclic_time,
    "gold_features": gold_features,
    "gold_features_daily": gold_features_daily,
    "dq_violations": dq_violations,
    "dq_spikes": dq_spikes,
    "dq_report": dq_report,
    "dq_samples": dq_samples,
    "dq_quarantine": dq_quarantine,
    "dq_non_finite": dq_non_finite,
    "dedup_keep_last": dedup_keep_last,
    "time_normalize": time_normalize,
    "time_from_epoch": time_from_epoch,
    "session_open_shift": session_open_shift,
    "conform_fill": conform_fill,
    "drop_null_prices": drop_null_prices,
    "finite_rows": finite_rows,
    "rollover_gaps": rollover_gaps,
    "splice_backward": _spliced(splice.splice_series),
    "splice_broadcast": _spliced(splice.splice_broadcast),
    "splice_open_gap": _spliced(splice.splice_series, "open"),
    "frac_diff": _feature(fractional_difference, ["close"], "frac_diff_close"),
    "frac_diff_sliced": frac_diff_sliced,
    "frac_diff_ticks": frac_diff_ticks,
    "frac_diff_orders": frac_diff_orders,
    "frac_diff_least_order": frac_diff_least_order,
    "frac_diff_adf": frac_diff_adf,
    "silver_prepare": silver_prepare,
    "silver_clean": silver_clean,
    "layers_incremental": layers_incremental,
    "layer_range_replace": layer_range_replace,
    "splice_asof": splice_asof,
    "splice_sliced": splice_sliced,
    "gold_features_sliced": gold_features_sliced,
    "series_verdicts": series_verdicts,
    "layer_row_balance": layer_row_balance,
    "bronze_append": bronze_append,
    "layer_replace": layer_replace,
    "layers_report": layers_report,
    "stale_batches": stale_batches,
    "fresh_ticks": fresh_ticks,
    "drift_audit": drift_audit,
    "drift_alert_days": drift_alert_days,
    "contract_decode": contract_decode,
    "expiry_calendar": expiry_calendar,
    "perpetual_roll": perpetual_roll,
    "perpetual_chain": perpetual_chain,
    "stream_hourly_bars": stream_hourly_bars,
    "stream_features": stream_features,
    "stream_fresh_ticks": stream_fresh_ticks,
    "stream_dead_letters": stream_dead_letters,
}
