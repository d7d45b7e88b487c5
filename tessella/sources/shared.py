"""The folder that all executors share, and tables written to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. One of our own only where that is unset and everything runs on this machine, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(path or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """A table written to the shared folder and read again: it is computed once, and its lineage is cut."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
