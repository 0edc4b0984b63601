"""Where cut lineage goes: reliable checkpoints in the folder that the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from variorum.scratch import checkpoint_folder


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to `spark.checkpoint.dir` and read from there after.

    All executors share that folder, so rows outlive a lost executor.  With
    `spark.cleaner.referenceTracking.cleanCheckpoints` Spark deletes them once the
    DataFrame is no longer in use.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
