"""Writing and re-reading the clean catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PARQUET_NAME = "titles_clean.parquet"
CSV_NAME = "titles_clean.csv"


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str] = ("release_year", "vote_average"),
                    key: str = "id", files: int | None = None) -> None:
    """Parquet in files of neighbouring values, with a bloom filter on the key.

    Rows are dealt by ranges and sorted inside, so that the statistics of files and row groups
    rule most of them out for a filter on the first column, or on both, and the bloom filter does
    for a lookup of a key.  The key is the last column of the order: equal values are dealt over
    as many files as they need.
    """
    order = [*by, key]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    (dealt.sortWithinPartitions(*order).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header.  One file has one writer: with `single_file` the rows stream through one
    task, which holds none of them; what computes them still runs in parallel."""
    out = df.repartition(1) if single_file else df
    # Quotes are doubled, so texts with quotes, commas and line breaks come back unchanged.
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Null and '' both come back as null: CSV is for exchange, Parquet is the stored form."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(path))


def save_clean(df: DataFrame, directory: str, single_csv: bool = False) -> DataFrame:
    """Write Parquet, then CSV from that Parquet, so the cleaning runs once.  Returns the table."""
    write_parquet(df, f"{directory}/{PARQUET_NAME}")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{directory}/{PARQUET_NAME}")
    write_csv(stored, f"{directory}/{CSV_NAME}", single_csv)
    return stored
