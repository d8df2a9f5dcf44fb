"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.plans.scratch import scratch_path

# What counts as part of a word.  Alphanumeric words: digits, letters, all
# above ASCII.  The upper-case letters are in it, so that it also fits text not yet lowered.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Words between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and nothing else; pure ASCII text takes the fast way."""
    return (F.when(F.length(text) == F.octet_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def words(text: Column, pattern: str = ALNUM_WORD) -> Column:
    """The lowered words in order; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gram_hash(array: Column, start: Column, n: int) -> Column:
    """The hash of the n words from `start` on."""
    return F.xxhash64(*[F.get(array, start + j) for j in range(n)])


def gram_text(array: Column, start: Column, n: int) -> Column:
    return F.concat_ws(" ", *[F.get(array, start + j) for j in range(n)])


def grams(array: Column, n: int, hashes: list[int] | None) -> Column:
    """The windows of n words as (pos, gram), those only whose hash is in `hashes` if given.

    Positions without a full window are left out.  The check of the hash is a set lookup inside
    the row, so text without hits makes no rows at all.
    """
    starts = F.when(F.size(array) >= n, F.sequence(F.lit(0), F.size(array) - n)).otherwise(
        F.array().cast("array<int>"))
    if hashes is not None:
        starts = F.filter(starts, lambda i: gram_hash(array, i, n).isin(hashes))
    return F.transform(starts, lambda i: F.struct(
        i.alias("pos"), F.lit(n).alias("n"), gram_text(array, i, n).alias("gram")))
