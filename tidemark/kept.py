"""Results that several later steps read are kept in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is not set, a local session gets a temporary one, and a cluster raises."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
    return context._jsc.sc().getCheckpointDir().get()


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and read from the shared folder from then on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
