"""Session set-up and the few settings the library reads from it."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "tarifold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and UTC clocks switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for ``DataFrame.checkpoint``.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is used
    as it is. Only in local mode (tests, a laptop) a folder is made where nothing is configured:
    elsewhere executors would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not configured and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"spark.checkpoint.dir names no shared folder, which {context.master} needs")
    folder = configured or tempfile.mkdtemp(prefix="tarifold-checkpoint-")
    context.setCheckpointDir(folder)
    return folder
