"""Reading raw nested JSON records with a declared schema."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAMED = T.StructType([T.StructField("name", T.StringType())])
_NAMED_LIST = T.ArrayType(_NAMED)
_CREW = T.ArrayType(T.StructType([T.StructField("job", T.StringType()),
                                  T.StructField("name", T.StringType())]))

# Only fields that cleaning uses, so the parser skips all others.  Numbers are read as text:
# 12, 12.0 and "12" all survive, and the cleaning turns what is no number into null.
RAW_SCHEMA = T.StructType([
    *[T.StructField(name, T.StringType()) for name in (
        "id", "title", "tagline", "overview", "status", "original_language", "release_date",
        "budget", "revenue", "runtime", "popularity", "vote_average", "vote_count")],
    T.StructField("belongs_to_collection", _NAMED),
    T.StructField("genres", _NAMED_LIST),
    T.StructField("production_countries", _NAMED_LIST),
    T.StructField("production_companies", _NAMED_LIST),
    T.StructField("spoken_languages", _NAMED_LIST),
    T.StructField("keywords", T.StructType([T.StructField("keywords", _NAMED_LIST)])),
    T.StructField("credits", T.StructType([T.StructField("cast", _NAMED_LIST),
                                           T.StructField("crew", _CREW)])),
])


def read_records(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
                 multi_line: bool = True) -> DataFrame:
    """The *.json files right below `path`.

    With `multi_line` a file may hold one pretty-printed record (or an array), and is read whole
    by one task.  For volume, land one record per line and pass False: such files are split.
    No schema is inferred, so nothing is read before an action.
    """
    return (spark.read.schema(schema).option("multiLine", multi_line)
            .option("pathGlobFilter", "*.json").json(path))


def scan_cached(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
                multi_line: bool = True) -> DataFrame:
    """The same scan, kept by the executors for several operators, on disk where it does not fit
    in memory.  A lost executor's part is read again.  The caller unpersists it."""
    return read_records(spark, path, schema, multi_line).persist(StorageLevel.MEMORY_AND_DISK)


_BROKEN = "__broken"


def read_with_quarantine(spark: SparkSession, path: str, quarantine: str,
                         schema: T.StructType = RAW_SCHEMA, key: str = "id",
                         pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """The good records of JSON lines, and those set aside with file, reason and text.

    A line is broken if it does not parse, or not into the declared types.  A record without a
    numeric key cannot be stored under one and is set aside too.  Both kinds are appended to the
    Parquet folder `quarantine` in the one pass that this function makes; the good records stay
    lazy.  A record the parser accepts in part counts as broken whole.
    """
    lines = (spark.read.schema(T.StructType([*schema, T.StructField(_BROKEN, T.StringType())]))
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
             .option("pathGlobFilter", pattern).json(path))
    usable = F.col(key).try_cast("bigint").isNotNull()
    reason = (F.when(F.col(_BROKEN).isNotNull(), "unreadable")
              .when(F.col(key).isNull(), "no key").when(~usable, "key is no number"))
    told = lines.withColumns({"__reason": reason, "__file": F.col("_metadata.file_name")})
    text = F.coalesce(F.col(_BROKEN), F.to_json(F.struct(*[f.name for f in schema])))
    aside = told.filter(F.col("__reason").isNotNull()).select(
        F.col("__file").alias("file_name"), F.col("__reason").alias("reason"),
        text.alias("record"))
    aside.write.mode("append").parquet(quarantine)
    good = told.filter(F.col("__reason").isNull()).drop(_BROKEN, "__reason", "__file")
    return good, spark.read.schema(aside.schema).parquet(quarantine)
