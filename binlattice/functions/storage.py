"""Tables that several steps read, written once to a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; a temporary folder only for local masters without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/binlattice/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to a shared folder, which ends their lineage."""
    path = shared_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
