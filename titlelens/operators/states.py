"""Group rollups kept as partial sums, so that new titles are added without reading old ones.

One pass over new titles makes, for each director, series, genre, and genre and year, the counts
and sums that all group measures are made of.  They are appended to a stored table; merging is a
sum, so the table may hold any number of parts, and `compact` makes one of them.  Titles that
leave, or change, are taken out by the negative sums of their old rows.  Rankings, listings and
trends over any of the dimensions are read from the states alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.functions.metrics import with_metrics
from titlelens.functions.tokens import split_tokens
from titlelens.operators.rank import take_ranked
from titlelens.operators.rollup import GROUP_MEASURES

# The measured columns.
MEASURED = {"budget": "budget_musd", "revenue": "revenue_musd", "rating": "vote_average",
            "votes": "vote_count"}
DIMENSIONS = ["collection_name", "director", "genre"]
SUMS = ["titles", *[f"{side}_{name}" for name in MEASURED for side in ("known", "sum")]]


def partial_states(titles: DataFrame, sign: int = 1) -> DataFrame:
    """dimension, key, year, and counts and sums: one row per group of these titles.

    A title is spread to one row for each of its groups, in one grouping with a map-side part;
    genres are also grouped by year.  With `sign=-1` the states take the titles out again.
    """
    rows = with_metrics(titles, "release_year")
    no_year = F.lit(None).cast("int")

    def of(dimension: str, key: Column, year: Column = no_year) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), key.alias("key"), year.alias("year"))

    genres = F.coalesce(split_tokens("genres"), F.array().cast("array<string>"))
    year = F.col("release_year")
    groups = F.concat(
        F.array(of("collection_name", F.col("collection_name")),
                of("director", F.col("director"))),
        F.transform(genres, lambda g: of("genre", g)),
        F.transform(genres, lambda g: of("genre_year", g, year)))
    spread = (rows.select(F.explode(groups).alias("group"), *MEASURED.values())
              .select("group.*", *MEASURED.values())
              .filter("key IS NOT NULL AND (dimension != 'genre_year' OR year IS NOT NULL)"))
    sums = [(F.count("*") * sign).alias("titles")]
    for name, column in MEASURED.items():
        sums += [(F.count(column) * sign).alias(f"known_{name}"),
                 (F.sum(F.col(column).cast("double")) * sign).alias(f"sum_{name}")]
    return spread.groupBy("dimension", "key", "year").agg(*sums)


def merged(states: DataFrame) -> DataFrame:
    """One row per group; groups whose titles have all been taken out are gone."""
    sums = [F.sum(c).alias(c) for c in SUMS]
    return states.groupBy("dimension", "key", "year").agg(*sums).filter("titles > 0")


def add_titles(titles: DataFrame, path: str, sign: int = 1) -> None:
    """Append the states of more titles (or, with -1, take titles out).  Nothing is read but
    these titles; dimensions are folders."""
    (partial_states(titles, sign).repartition("dimension", "key")
     .write.mode("append").partitionBy("dimension").parquet(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    kinds = {**{c: "long" for c in SUMS if not c.startswith("sum_")},
             **{c: "double" for c in SUMS if c.startswith("sum_")}}
    ddl = "key string, year int, " + ", ".join(f"{c} {kinds[c]}" for c in SUMS)
    return merged(spark.read.schema(f"{ddl}, dimension string").parquet(path))


def compact(spark: SparkSession, path: str, new_path: str) -> None:
    """All parts as one, in another folder."""
    (read_states(spark, path).repartition("dimension", "key")
     .write.partitionBy("dimension").parquet(new_path))


def _measures() -> dict[str, Column]:
    def total(name: str) -> Column:
        return F.when(F.col(f"known_{name}") > 0, F.col(f"sum_{name}"))

    def mean(name: str) -> Column:
        return F.try_divide(F.col(f"sum_{name}"), F.col(f"known_{name}"))

    return {"movie_count": F.col("titles"), "total_budget_musd": total("budget"),
            "mean_budget_musd": mean("budget"), "total_revenue_musd": total("revenue"),
            "mean_revenue_musd": mean("revenue"), "mean_rating": mean("rating"),
            "mean_vote_count": mean("votes")}


def top_groups(states: DataFrame, dimension: str, n: int = 10,
               sort_by: str = "total_revenue_musd", min_titles: int = 1) -> DataFrame:
    """As the rollup of the same name, for `collection_name`, `director` or `genre`."""
    groups = states.filter((F.col("dimension") == dimension) & (F.col("titles") >= min_titles))
    measured = groups.select(F.col("key").alias(dimension),
                             *[m.alias(c) for c, m in _measures().items()])
    ranked = take_ranked(measured, [F.desc(sort_by), F.asc(dimension)], n)
    return ranked.select("rank", dimension, *GROUP_MEASURES)


def genre_year_trend(states: DataFrame) -> DataFrame:
    groups = states.filter("dimension = 'genre_year'")
    return groups.select(F.col("key").alias("genre"), F.col("year").alias("release_year"),
                         *[m.alias(c) for c, m in _measures().items()]).orderBy(
        "genre", "release_year")


def after_landings(landings: list[DataFrame], path: str,
                   answer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`answer` over the states of several landings of different titles."""
    for titles in landings:
        add_titles(titles, path)
    return answer(read_states(landings[0].sparkSession, path))
