"""Multi-valued attributes: arrays of records on the raw side, pipe-joined text once cleaned."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"


def join_tokens(array: Column) -> Column:
    """Null array -> null, empty array -> '', null elements are left out."""
    return F.array_join(array, SEPARATOR)


def split_tokens(column: str | Column) -> Column:
    """Null -> null, '' -> one empty token."""
    return F.split(column, "[|]")


def sort_tokens_of(column: str | Column) -> Column:
    return join_tokens(F.array_sort(split_tokens(column)))


def explode_tokens(df: DataFrame, column: str, alias: str, drop_empty: bool = False) -> DataFrame:
    """One row per token in a new column `alias`; a null value gives no row."""
    exploded = df.withColumn(alias, F.explode(split_tokens(column)))
    return exploded.filter(F.col(alias) != "") if drop_empty else exploded


def as_list(words: str | Iterable[str]) -> list[str]:
    return [words] if isinstance(words, str) else list(words)


def matches(column: str, words: str | Iterable[str], *, every: bool, ignore_case: bool = False,
            exact: bool = False) -> Column:
    """Does the text hold every (or any) word?  Substring match, or whole tokens when `exact`.

    No words at all: true for `every`, false for any.
    """
    text = F.lower(column) if ignore_case else F.col(column)

    def one(word: str) -> Column:
        # Both sides are lowered by the engine, so its case rules apply to both.
        needle = F.lower(F.lit(word)) if ignore_case else F.lit(word)
        return F.array_contains(split_tokens(text), needle) if exact else F.contains(text, needle)

    return reduce(and_ if every else or_, map(one, as_list(words)), F.lit(every))
