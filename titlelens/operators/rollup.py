"""Group rollups by series, person, genre and year, and the listings behind them.

All groupings use aggregates with a map-side part, so a group that holds a large share of the
rows reaches its reducer as one partial result per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.functions.metrics import title_kind, with_metrics
from titlelens.functions.tokens import explode_tokens, matches
from titlelens.operators.quantiles import quantiles
from titlelens.operators.rank import take_ranked
from titlelens.plans.scratch import stored

GROUP_MEASURES = ["movie_count", "total_budget_musd", "mean_budget_musd", "total_revenue_musd",
                  "mean_revenue_musd", "mean_rating", "mean_vote_count"]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def _measures() -> list[Column]:
    return [
        F.count("*").alias("movie_count"),
        F.sum("budget_musd").alias("total_budget_musd"),
        F.avg("budget_musd").alias("mean_budget_musd"),
        F.sum("revenue_musd").alias("total_revenue_musd"),
        F.avg("revenue_musd").alias("mean_revenue_musd"),
        F.avg("vote_average").alias("mean_rating"),
        F.avg("vote_count").alias("mean_vote_count"),
    ]


def group_measures(df: DataFrame, *keys: str) -> DataFrame:
    """Counts, money totals and means per group; rows without a key are left out."""
    known = df.dropna("any", subset=list(keys))
    return known.groupBy(*keys).agg(*_measures())


def top_groups(df: DataFrame, key: str, n: int = 10, sort_by: str = "total_revenue_musd",
               min_titles: int = 1) -> DataFrame:
    """The `n` best groups by any measure; equal ones in key order."""
    groups = group_measures(df, key)
    if min_titles > 1:
        groups = groups.filter(F.col("movie_count") >= min_titles)
    ranked = take_ranked(groups, [F.desc(sort_by), F.asc(key)], n)
    return ranked.select("rank", key, *GROUP_MEASURES)


def top_franchises(df: DataFrame, n: int = 10, sort_by: str = "total_revenue_musd") -> DataFrame:
    return top_groups(df, "collection_name", n, sort_by)


def top_directors(df: DataFrame, n: int = 10, sort_by: str = "total_revenue_musd",
                  min_titles: int = 1) -> DataFrame:
    return top_groups(df, "director", n, sort_by, min_titles)


def top_genres_by_revenue(df: DataFrame, n: int = 10, drop_empty: bool = False) -> DataFrame:
    return top_groups(explode_tokens(df, "genres", "genre", drop_empty), "genre", n)


def genre_year_trend(df: DataFrame, drop_empty: bool = False) -> DataFrame:
    """The group measures per genre and release year."""
    by_genre = explode_tokens(with_metrics(df, "release_year"), "genres", "genre", drop_empty)
    return group_measures(by_genre, "genre", "release_year").orderBy("genre", "release_year")


def compare_franchises(df: DataFrame, exact: bool = True) -> DataFrame:
    """Titles in a series against those in none: means, and the median return (an element).

    The exact median passes over the few columns used again, so these are written once; with
    `exact=False` a sketch gives it within a ten-thousandth of the rows in one pass.
    """
    flagged = with_metrics(df, "roi").select(
        title_kind().alias("is_franchise"), "roi", "revenue_musd", "budget_musd", "popularity",
        "vote_average")
    rows = None
    if exact:
        flagged = stored(flagged, "franchises")
        rows = flagged.count()
    means = {
        "movie_count": F.count("*"),
        "mean_revenue_musd": F.avg("revenue_musd"),
        "mean_budget_musd": F.avg("budget_musd"),
        "mean_popularity": F.avg("popularity"),
        "mean_rating": F.avg("vote_average"),
    }
    compared = quantiles(flagged, "roi", [0.5], ["is_franchise"], max_groups=2, exact=exact,
                         element=True, also=means, rows=rows)
    return (compared.withColumn("median_roi", F.col("quantiles")[0])
            .select("is_franchise", "movie_count", "mean_revenue_musd", "median_roi",
                    "mean_budget_musd", "mean_popularity", "mean_rating")
            .orderBy(F.desc("is_franchise")))


def _listing(df: DataFrame, *extra: str) -> DataFrame:
    listed = df.select("title", "release_year", "budget_musd", "revenue_musd", "vote_average",
                       "vote_count", "popularity", *extra)
    return listed.orderBy("release_year", "title")


def franchise_details(df: DataFrame, name: str) -> DataFrame:
    """Titles whose series name holds `name` (case counts), by year."""
    found = df.filter(matches("collection_name", name, every=True))
    return _listing(found, "director", "collection_name")


def director_details(df: DataFrame, name: str) -> DataFrame:
    """Titles whose director's name holds `name` (case does not count), by year."""
    found = df.filter(matches("director", name, every=True, ignore_case=True))
    return _listing(found, "genres", "collection_name")


def token_counts(df: DataFrame, column: str = "genres", alias: str = "genre", n: int = 15,
                 drop_empty: bool = False) -> DataFrame:
    """The `n` most frequent tokens of a multi-valued column."""
    tokens = explode_tokens(df.select(column), column, alias, drop_empty)
    counts = tokens.groupBy(alias).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(alias)).limit(n)


def titles_per_year(df: DataFrame, years: int = 20) -> DataFrame:
    """Titles in each of the most recent years, oldest first.

    An unknown year is a group of its own and counts as the oldest; it is shown last.
    """
    per_year = (with_metrics(df, "release_year").groupBy("release_year")
                .agg(F.count("*").alias("count")))
    recent = per_year.orderBy(F.desc_nulls_last("release_year")).limit(years)
    return recent.orderBy(F.asc_nulls_last("release_year"))
