"""A folder for tables written on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder the session names; a local one only in local mode."""
    shared = spark.conf.get(_KEY, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_KEY} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="titlelens-")
        spark.conf.set(_KEY, shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: what follows reads only its columns,
    and a lost executor costs no more than a read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
