"""Which records have landed, and which are still to be loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of each landed *.json file.  The files are listed, not opened."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
             .select("path", "length", "modificationTime"))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                        F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified_at"))


def landed_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids with a landed file `{id}.json`, or a folder of that name or partition value with a
    *.json file in it, once each.  Other names are not counted.  Nothing is opened."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
             .select("path"))
    stem = F.regexp_extract("path", r"[/=](-?\d+)\.json(?:/|$)", 1)
    named = files.select(stem.try_cast("bigint").alias("id"))
    return named.filter(F.col("id").isNotNull()).distinct()


def ids_to_load(wanted: DataFrame, landed: DataFrame, key: str = "id") -> DataFrame:
    """Wanted ids, each once, that have not landed.

    Both sides are reduced to one row per id before they meet, so repeated ids cannot pile up.
    """
    return wanted.select(key).distinct().join(landed.select(key).distinct(), key, "left_anti")


def load_count(wanted: DataFrame, landed: DataFrame, key: str = "id") -> DataFrame:
    return ids_to_load(wanted, landed, key).agg(F.count("*").alias("to_load"))
