"""An index for substring searches: which rows hold which three characters in a row.

`build_index` writes one posting per row and distinct trigram of each indexed text, and a table
of how often each trigram occurs.  Postings are laid out in folders by column and by a hash of
the trigram, sorted inside, so that a search opens only the folders of its trigrams and skips
most row groups of those.  A trigram that stands in a third of all rows is spread over as many
tasks as any other data of that size: the layout is by range, with the row's key last.

A search takes the rarest trigrams of each word, intersects their postings, and verifies the rows
found with the same predicate as the plain filter, which is why both always agree.  Words of
fewer than three characters have no trigram; they are left to the plain filter.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small
from titlelens.functions.tokens import as_list, matches

GRAM = 3
# Postings of a word that are intersected.
RAREST = 4
FOLDERS = 64


class SubstringIndex(NamedTuple):
    spark: SparkSession
    path: str
    key: str
    # column -> whether case is ignored
    columns: Mapping[str, bool]


def grams(text: Column) -> Column:
    """The distinct trigrams of a text; none for null and short ones.

    Cut by a regular expression from each of the first characters on: a lambda over the positions
    is not compiled and takes several times as long.
    """
    cut = lambda start: F.regexp_extract_all(
        F.substring(text, start, 1 << 30), F.lit(f"(?s).{{{GRAM}}}"), F.lit(0))
    return F.coalesce(F.array_distinct(F.concat(*[cut(i + 1) for i in range(GRAM)])),
                      F.array().cast("array<string>"))


def _folded(column: str, ignore_case: bool) -> Column:
    return F.lower(F.col(column)) if ignore_case else F.col(column)


def _folder(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FOLDERS)).cast("int")


def build_index(df: DataFrame, path: str, columns: Mapping[str, bool], key: str = "id"
                ) -> SubstringIndex:
    """Index text columns of `df`; its `key` must be unique and not null.

    `columns` says of each whether searches ignore its case.  Store `df` first: it is read here
    and again by each search.
    """
    spark = df.sparkSession
    texts = F.array(*[F.struct(F.lit(name).alias("text_of"), grams(_folded(name, fold)).alias(
        "grams")) for name, fold in columns.items()])
    rows = (df.select(F.col(key).alias("key"), F.explode(texts).alias("text"))
            .select("key", "text.text_of", F.explode("text.grams").alias("gram"))
            .withColumn("folder", _folder(F.col("gram"))))
    (rows.repartitionByRange("text_of", "folder", "gram", "key")
     .sortWithinPartitions("text_of", "folder", "gram", "key")
     .write.partitionBy("text_of", "folder").parquet(f"{path}/postings"))
    counts = (spark.read.parquet(f"{path}/postings").groupBy("text_of", "folder", "gram")
              .agg(F.count("*").alias("n")))
    (counts.repartitionByRange("text_of", "folder", "gram")
     .sortWithinPartitions("text_of", "folder", "gram")
     .write.partitionBy("text_of", "folder").parquet(f"{path}/counts"))
    return SubstringIndex(spark, path, key, dict(columns))


def _of_grams(index: SubstringIndex, table: str, column: str, wanted: list[str]) -> DataFrame:
    """The rows of some trigrams; folders are pruned by literals, row groups by the trigram."""
    folders = sorted({r[0] for r in index.spark.createDataFrame(
        [(g,) for g in wanted], "gram string").select(_folder(F.col("gram"))).collect()})
    return index.spark.read.parquet(f"{index.path}/{table}").filter(
        (F.col("text_of") == column) & F.col("folder").isin(folders) & F.col("gram").isin(wanted))


def candidates(index: SubstringIndex, column: str, word: str) -> DataFrame | None:
    """The keys of rows that hold the rarest trigrams of the word; None if it has none.

    The word's trigrams and their counts, some numbers for each of its letters, are looked at by
    the driver; a trigram without postings gives an empty frame.
    """
    folded = F.lower(F.lit(word)) if index.columns[column] else F.lit(word)
    wanted = index.spark.range(0, 1, 1, 1).select(grams(folded)).first()[0]
    if not wanted:
        return None
    found = {r["gram"]: r["n"] for r in _of_grams(index, "counts", column, wanted)
             .select("gram", "n").collect()}
    rarest = sorted(wanted, key=lambda g: (found.get(g, 0), g))[:RAREST]
    postings = _of_grams(index, "postings", column, rarest)
    # A row has one posting for each of its trigrams.
    keys = (postings.groupBy("key").agg(F.count("*").alias("held"))
            .filter(F.col("held") == len(rarest)).select(F.col("key").alias(index.key)))
    return broadcast_if_small(keys, min(found.get(g, 0) for g in rarest))


def filter_indexed(df: DataFrame, index: SubstringIndex, column: str, words: str | Iterable[str],
                   every: bool = True) -> DataFrame:
    """The rows of the indexed frame whose text holds every (or any) word, found by the index."""
    words = as_list(words)
    found = [candidates(index, column, w) for w in words]
    known = [keys for keys in found if keys is not None]
    if every:
        some = reduce(lambda rows, keys: rows.join(keys, index.key, "left_semi"), known, df)
    elif words and len(known) == len(words):
        some = df.join(reduce(DataFrame.union, known).distinct(), index.key, "left_semi")
    else:
        some = df
    return some.filter(matches(column, words, every=every, ignore_case=index.columns[column]))


def search_indexed(df: DataFrame, index: SubstringIndex, genres: Iterable[str] | str | None = None,
                   actors: Iterable[str] | str | None = None,
                   directors: Iterable[str] | str | None = None) -> DataFrame:
    """All genres, any actor, any director, as `search.search` finds them; not sorted."""
    for column, words, every in (("genres", genres, True), ("cast", actors, False),
                                 ("director", directors, False)):
        if words is not None:
            df = filter_indexed(df, index, column, words, every)
    return df
