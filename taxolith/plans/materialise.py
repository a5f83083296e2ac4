"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which all executors share.

    Only where that is unset and the executors are threads of this machine, as in a local
    test, a temporary folder is used; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="taxolith-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
