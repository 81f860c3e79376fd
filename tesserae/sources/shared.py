"""Tables in the folder that driver and executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; one of our own only in local mode, as in tests."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
        there = tempfile.mkdtemp(prefix="tesserae-")
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once, written and read back: its lineage ends here."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
