"""What the operators share: the shared folder, staging, and native text expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session that names none gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    spark = frame.sparkSession
    path = new_path(spark, purpose)
    frame.write.parquet(path)
    staged = spark.read.schema(frame.schema).parquet(path)
    staged.staged_path = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete staged frames that nothing reads any more."""
    for frame in staged:
        if path := getattr(frame, "staged_path", None):
            jvm = frame.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            conf = frame.sparkSession._jsparkSession.sessionState().newHadoopConf()
            target.getFileSystem(conf).delete(target, True)


def extended(frame: DataFrame, added: str) -> T.StructType:
    """The frame's schema with further columns."""
    return T.StructType([*frame.schema.fields, *T.StructType.fromDDL(added).fields])


def training_row(doc_id: str | Column = "doc_id") -> Column:
    """Rows a model may learn from: crc32 of the id as text, mod 4, is not 2."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """A-Z only; the fast ``lower`` where the text has no other characters."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of separators; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def covered(spans: Column) -> Column:
    """Number of positions that spans (start, length), sorted by start, cover."""
    begin = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def step(acc: Column, span: Column) -> Column:
        start = span["start"].cast("long")
        end = F.greatest(start + span["length"], acc["end"])
        return F.struct(
            end.alias("end"),
            (acc["total"] + end - F.greatest(start, acc["end"])).alias("total"),
        )

    return F.aggregate(spans, begin, step, lambda acc: acc["total"])
