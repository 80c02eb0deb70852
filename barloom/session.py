"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing stays with the caller."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below ``spark.checkpoint.dir``, the folder all executors share.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="barloom-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
