"""Layer datasets: parquet, partitioned by data type, symbol, timeframe and time range.

A range (``period``) holds ``PERIOD_ROWS`` bars of the series' own timeframe, so a long
series lies in many folders, a short one in one, and a later build can replace the
ranges it touches.
"""

from __future__ import annotations

import logging
import time
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.times import micros, step_seconds_of
from barloom.schemas import (
    ALERTS, BRONZE, CLEAN, GOLD, KEY, LEDGER, PERIOD, QUARANTINE, SILVER, TICKS, on_key,
)
from barloom.session import work_folder

log = logging.getLogger(__name__)

SCHEMAS = {
    "bronze": BRONZE, "clean": CLEAN, "ledger": LEDGER, "silver": SILVER, "gold": GOLD, "quarantine": QUARANTINE,
}
#: Layers whose series are cut into ranges.
RANGED = ("clean", "silver", "gold", "quarantine")
PERIOD_ROWS = 1 << 17
DEFAULT_DATA_TYPE = "futures"
TICK_SALTS = 8
UNTIMED_SALTS = 64


def layer_path(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/{layer}"


def period_of(time: Column, timeframe: Column, rows: int = PERIOD_ROWS) -> Column:
    """The start of the range that a time belongs to; a function of time and label alone."""
    width = (step_seconds_of(F.coalesce(timeframe, F.lit(""))) * F.lit(rows * 1e6)).cast("bigint")
    return micros(time) - F.pmod(micros(time), width)


def _in_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def _folder_value(path: Column, name: str) -> Column:
    """The value that a folder such as ``symbol=A`` names."""
    text = F.regexp_extract(path, rf"^.*/{name}=([^/]*)/", 1)
    value = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(text != "__HIVE_DEFAULT_PARTITION__", value)


def layer_files(spark: SparkSession, base: str, layer: str) -> DataFrame:
    """(data_type, symbol, timeframe, period, path) of a layer's files, from their names alone."""
    path = layer_path(base, layer)
    if _exists(spark, path):
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        found = listing.option("pathGlobFilter", "*.parquet").load(path)
    else:
        found = spark.createDataFrame([], "path string")
    keys = {name: _folder_value(F.col("path"), name) for name in (*KEY, PERIOD)}
    files = found.select("path").withColumns(keys)
    return files.withColumn(PERIOD, F.col(PERIOD).try_cast("bigint"))


def listed_series(spark: SparkSession, base: str, layer: str) -> DataFrame:
    """The series that have rows in a layer."""
    return layer_files(spark, base, layer).select(*KEY).distinct()


def _drop_leftovers(spark: SparkSession, base: str, layer: str, old: DataFrame, seen: DataFrame | None) -> None:
    """Delete the files that a write should have replaced and did not, having no rows for them.

    These are old files still there, of series that have new files or that are in ``seen``.
    If ``seen`` has a column ``since``, only ranges from there on were to be replaced.
    """
    now = layer_files(spark, base, layer)
    left = old.join(now.select("path"), "path", "left_semi")
    if seen is None or "since" not in seen.columns:
        done = now.join(old.select("path"), "path", "left_anti").select(*KEY)
        done = (done if seen is None else done.unionByName(seen.select(*KEY))).distinct()
        left = left.join(done, on_key(left, done), "left_semi")
    else:
        later = F.col("since").isNull() | F.col(PERIOD).isNull() | (F.col(PERIOD) >= F.col("since"))
        left = left.join(seen, on_key(left, seen) & later, "left_semi")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for row in left.select("path").toLocalIterator():
        target = spark._jvm.org.apache.hadoop.fs.Path(row["path"])
        target.getFileSystem(conf).delete(target, False)


def replace_series(df: DataFrame, base: str, layer: str, seen: DataFrame | None = None) -> str:
    """Write whole series: those in the frame replace their old files, others stay.

    ``seen`` names all series that were processed; those without a row in the frame lose
    their old files. With a column ``since`` (a range's start, or null for all), the frame
    holds the rows from there on, and earlier ranges stay as they are. The frame is
    computed once: what was replaced is told from the files' names. It comes partitioned by
    series and slice, so each task writes few files; rows are in time order within a file.
    """
    path = layer_path(base, layer)
    spark = df.sparkSession
    old = stage(layer_files(spark, base, layer), "files") if _exists(spark, path) else None
    rows, ranges = _in_schema(df, SCHEMAS[layer]), []
    if layer in RANGED:
        rows, ranges = rows.withColumn(PERIOD, period_of(F.col("time"), F.col("timeframe"))), [PERIOD]
    (
        rows.sortWithinPartitions(*KEY, *ranges, "time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*KEY, *ranges)
        .parquet(path)
    )
    if old is not None:
        _drop_leftovers(spark, base, layer, old, seen)
    return path


def by_range(df: DataFrame) -> DataFrame:
    """Dealt so that one task writes a range of a series; rows without a time go to any of many."""
    anywhere = F.pmod(F.xxhash64(*df.columns), F.lit(UNTIMED_SALTS))
    return df.repartition(*KEY, F.coalesce(period_of(F.col("time"), F.col("timeframe")), anywhere))


def append_rows(df: DataFrame, base: str, layer: str) -> str:
    path = layer_path(base, layer)
    df.write.mode("append").partitionBy(*KEY).parquet(path)
    return path


def _selected(df: DataFrame, **wanted: str | None) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def _bronze_schema(found: T.StructType) -> T.StructType:
    fields = [
        T.StructField(f.name, T.StringType() if f.name in KEY else f.dataType)
        for f in found.fields
    ]
    names = {f.name for f in fields} | ({"time"} if "timestamp" in found.names else set())
    known = [f for f in BRONZE.fields if f.name not in names]
    return T.StructType([*known, *fields])


def read_layer(
    spark: SparkSession,
    base: str,
    layer: str,
    data_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Scan a layer; key predicates prune directories, and so do ``since`` and ``until``.

    The schema is given, so a symbol such as ``007`` stays text. Bronze keeps
    whatever columns arrived: those of one file, and the known ones, which other
    files may have. A missing layer is an empty frame.
    """
    path = layer_path(base, layer)
    if layer == "ticks":
        return _selected(
            read_ticks(spark, base), data_type=data_type, symbol=symbol, timeframe=timeframe
        )
    schema = SCHEMAS[layer]
    try:
        if layer == "bronze":
            schema = _bronze_schema(spark.read.parquet(path).schema)
        found = T.StructType([*schema, T.StructField(PERIOD, T.LongType())]) if layer in RANGED else schema
        df = spark.read.schema(found).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("no files in %s", path)
        return spark.createDataFrame([], schema)
    df = _selected(df, data_type=data_type, symbol=symbol, timeframe=timeframe)
    for bound, lower in ((since, True), (until, False)):
        if bound is not None:
            limit = F.lit(bound).cast("timestamp_ntz")
            df = df.where(F.col("time") >= limit if lower else F.col("time") < limit)
            if layer in RANGED:
                edge = period_of(limit, F.col("timeframe"))
                df = df.where(F.col(PERIOD) >= edge if lower else F.col(PERIOD) <= edge)
    return df.select(*schema.names)


def read_files(spark: SparkSession, base: str, layer: str, files: DataFrame, ranged: bool = False) -> DataFrame:
    """Scan the named files of a layer and no others; ``ranged`` adds the range's start.

    Their paths go through the driver, which lists the files of every scan anyway.
    """
    schema = SCHEMAS[layer]
    paths = [row["path"] for row in files.select("path").toLocalIterator()]
    if paths and layer == "bronze":
        schema = _bronze_schema(spark.read.option("basePath", layer_path(base, layer)).parquet(paths[0]).schema)
    found = T.StructType([*schema, T.StructField(PERIOD, T.LongType())]) if layer in RANGED else schema
    if paths:
        df = spark.read.schema(found).option("basePath", layer_path(base, layer)).parquet(*paths)
    else:
        df = spark.createDataFrame([], found)
    return df if ranged else df.select(*schema.names)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    For a result that several jobs read: it is computed once, survives lost
    executors, and each reader scans only its columns.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_ticks(df: DataFrame, base: str, feed: str, epoch: int) -> None:
    """Store ticks of one feed; the same feed and epoch again replaces its own rows only.

    A symbol's ticks are dealt to ``TICK_SALTS`` tasks at most, by their content, and so to
    as many files.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(TICK_SALTS))
    (
        df.withColumns({"feed": F.lit(feed), "epoch": F.lit(epoch).cast("bigint")})
        .repartition(*KEY, salt)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*KEY, "feed", "epoch")
        .parquet(layer_path(base, "ticks"))
    )


def read_ticks(spark: SparkSession, base: str) -> DataFrame:
    """All stored ticks of lists and streams; keys are text, and none stored is an empty frame."""
    path = layer_path(base, "ticks")
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("no files in %s", path)
        return spark.createDataFrame([], TICKS)
    text = {*KEY, "feed"}
    fields = [T.StructField(f.name, T.StringType()) if f.name in text else f for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def append_audit(audit: DataFrame, base: str) -> str:
    """Store the rows of an audit: alerts, and rows without title where all was well.

    The latter withdraw what an earlier audit said of the same model and time.
    """
    path = layer_path(base, "alerts")
    numbered = audit.withColumn("audit", F.lit(time.time_ns()))
    numbered.write.mode("append").partitionBy("alert_date").parquet(path)
    return path


def append_alerts(alerts: DataFrame, base: str) -> str:
    """Store alerts alone; earlier alerts of other models and times stay."""
    return append_audit(alerts, base)


def read_alerts(spark: SparkSession, base: str) -> DataFrame:
    """The alerts that stand: of each model and time what the latest audit said."""
    found = spark.read.schema(ALERTS).parquet(layer_path(base, "alerts"))
    rest = [name for name in ALERTS.names if name not in ("model", "ts", "audit")]
    latest = found.groupBy("model", "ts").agg(F.max_by(F.struct(*rest), "audit").alias("last"))
    return latest.select("model", "ts", *[F.col("last")[name].alias(name) for name in rest]).where("title is not null")
