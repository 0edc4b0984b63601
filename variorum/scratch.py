"""Where intermediate tables go: the folder in `spark.checkpoint.dir`, which all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; only a local session without one gets a new folder of this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(spark.sparkContext, "_variorum_scratch"):
        spark.sparkContext._variorum_scratch = tempfile.mkdtemp(prefix="variorum-")
    return spark.sparkContext._variorum_scratch


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure that `checkpoint()` has its folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder(spark))
