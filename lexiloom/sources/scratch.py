"""Folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the session names in spark.checkpoint.dir.

    A local session without that setting gets one folder, which is set in the
    session and removed when the process ends; any other session must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lexiloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: computed once, without its lineage."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)
