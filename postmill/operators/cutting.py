"""Cutting lineage between steps that are used more than once, in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset a temporary one, on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or "-cluster" in master:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="postmill-")
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept by checkpoint() in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint()
