"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from flowgauge.errors import bad_input

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names. On one machine alone a temporary one stands in where none is set."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise bad_input(f"name a folder that all executors share in {SETTING}")
    return tempfile.mkdtemp(prefix="flowgauge-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
