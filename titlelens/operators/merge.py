"""A stored catalog that takes in landings: the same table as one clean over all of them.

The state is the surviving raw row of each id, flat and typed, released or not, with the columns
that order the rows of an id.  The survivor is a minimum, so it does not matter in which order
landings come, or whether one comes twice.  Rows lie in `buckets` folders by a hash of the id,
each written by one task: choose their number, once for a table, so that a bucket is some hundred
megabytes.  A landing is reduced to its own survivors, and only the buckets it hits are read and
written anew, as files of a new version with a bloom filter on the id.  A manifest says which
version of each bucket counts; it is written last, so readers see a landing whole or not at all,
and a failed one leaves only files that nothing names.  Landings are taken in one at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlelens.operators import clean

BUCKETS = 64
_MANIFEST = "bucket int, folder string, buckets int, landing long"
_ORDER = ["__code", "status", "title", "__tie"]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def survivors(raw: DataFrame) -> DataFrame:
    """One flat row per id of a landing, with its order; rows without an id have no place."""
    flat = (raw.transform(clean.drop_unused).transform(clean.flatten_names)
            .transform(clean.fix_types).transform(clean.add_people)
            .drop("credits", "belongs_to_collection", "budget", "revenue"))
    order = {"__code": clean.survival_code(flat),
             "__tie": F.xxhash64(*[F.col(f"`{c}`") for c in flat.columns])}
    known = flat.withColumns(order).filter(F.col("id").isNotNull())
    return clean.dedupe(known, "id", _order(known))


def _order(rows: DataFrame) -> list[Column]:
    return [F.asc(c) for c in _ORDER if c in rows.columns]


def _told(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path}/manifest"
    spark.createDataFrame([], _MANIFEST).write.mode("ignore").partitionBy("landing").parquet(where)
    return spark.read.schema(_MANIFEST).parquet(where)


def manifest(spark: SparkSession, path: str) -> tuple[dict[int, str], int | None, int]:
    """bucket -> the folder that counts, the number of buckets, and of landings so far.

    One row a bucket is brought to the driver.
    """
    rows = (_told(spark, path).groupBy("bucket")
            .agg(F.max_by(F.struct("folder", "buckets"), "landing").alias("last"),
                 F.max("landing").alias("landing")).collect())
    return ({r["bucket"]: r["last"]["folder"] for r in rows},
            rows[0]["last"]["buckets"] if rows else None,
            max((r["landing"] + 1 for r in rows), default=0))


def _state(spark: SparkSession, schema: T.StructType, folders: dict[int, str]) -> DataFrame:
    paths = [f"{folder}/bucket={bucket}" for bucket, folder in sorted(folders.items())]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def merge_landing(raw: DataFrame, path: str, buckets: int = BUCKETS) -> int:
    """Take a landing's raw records into the table at `path`; returns the buckets written."""
    spark = raw.sparkSession
    current, made_with, landing = manifest(spark, path)
    if made_with not in (None, buckets):
        raise ValueError(f"the table has {made_with} buckets")
    folder = f"{path}/versions/{uuid.uuid4().hex}"
    landed = survivors(raw)
    # Written once: it tells which buckets are hit and is then merged into them.
    (landed.withColumn("bucket", _bucket(buckets)).repartition("bucket")
     .write.partitionBy("bucket").parquet(f"{folder}/landed"))
    new = spark.read.schema(T.StructType([*landed.schema, T.StructField(
        "bucket", T.IntegerType())])).parquet(f"{folder}/landed")
    hit = sorted(r[0] for r in new.select("bucket").distinct().collect())
    if not hit:
        return 0
    stored = _state(spark, landed.schema, {b: f for b, f in current.items() if b in hit})
    both = stored.unionByName(new.drop("bucket"))
    merged = clean.dedupe(both, "id", _order(both)).withColumn("bucket", _bucket(buckets))
    (merged.repartition("bucket").sortWithinPartitions("bucket", "id")
     .write.option("parquet.bloom.filter.enabled#id", "true")
     .partitionBy("bucket").parquet(f"{folder}/merged"))
    (spark.createDataFrame([(b, f"{folder}/merged", buckets, landing) for b in hit], _MANIFEST)
     .coalesce(1).write.mode("append").partitionBy("landing").parquet(f"{path}/manifest"))
    return len(hit)


def _finished(state: DataFrame) -> DataFrame:
    kept = state.filter(F.col("title").isNotNull())
    if "status" in kept.columns:
        kept = kept.filter("status = 'Released'")
    return (kept.drop("status", "__code", "__tie").transform(clean.add_features)
            .transform(clean.sort_tokens).transform(clean.canonical_columns))


def _shape(spark: SparkSession, schema: T.StructType) -> T.StructType:
    return survivors(spark.createDataFrame([], schema)).schema


def merged_titles(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The clean table of all landings so far.  `schema` is that of their raw records."""
    return _finished(_state(spark, _shape(spark, schema), manifest(spark, path)[0]))


def find_title(spark: SparkSession, path: str, schema: T.StructType, wanted: int) -> DataFrame:
    """The clean row of one id: one bucket is opened, and there the row groups whose bloom filter
    may hold the id."""
    folders, buckets, _ = manifest(spark, path)
    bucket = spark.range(wanted, wanted + 1, 1, 1).select(_bucket(buckets or 1)).first()[0]
    some = {b: f for b, f in folders.items() if b == bucket}
    return _finished(_state(spark, _shape(spark, schema), some).filter(F.col("id") == wanted))
