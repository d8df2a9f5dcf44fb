"""Top and bottom rankings by any metric."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlelens.functions.metrics import with_metrics
from titlelens.plans.scratch import stored

# The columns shown beside each metric.
CONTEXT_COLUMNS = {
    "revenue_musd": ["release_year", "budget_musd", "revenue_musd"],
    "budget_musd": ["release_year", "budget_musd", "revenue_musd"],
    "profit_musd": ["release_year", "budget_musd", "revenue_musd"],
    "roi": ["release_year", "budget_musd", "revenue_musd", "roi"],
    "vote_average": ["release_year", "vote_average", "vote_count"],
    "vote_count": ["release_year", "vote_average", "vote_count"],
    "popularity": ["release_year", "popularity", "vote_average"],
}


def take_ranked(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows by `order` with their `rank`.

    Sort plus limit becomes TakeOrderedAndProject: each task keeps its own best `n`, and only
    those meet in one place.  The window then numbers `n` rows that are in order already.
    """
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def rank_all(df: DataFrame, metric: str, ascending: bool = False, where: Column | None = None,
             tie: Sequence[str] | None = None) -> DataFrame:
    """Every row with a known metric, with its `rank` among all of them, equal ones by `tie`.

    A window over all rows would sort them in one task.  Here the rows are dealt to tasks by
    ranges of the order and sorted there, and written with the number each has in its task.  The
    counts of the tasks before, one number a task, make it the rank.  The table is written, so
    that numbers and counts come from the same ranges even if an executor is lost between.
    """
    rows = with_metrics(df, "release_year", metric)
    if where is not None:
        rows = rows.filter(where)
    direction = F.asc if ascending else F.desc
    order = [direction(metric), *[F.asc(c) for c in tie_columns(df, tie)]]
    placed = (rows.filter(F.col(metric).isNotNull()).repartitionByRange(*order)
              .sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()))
    placed = stored(placed, "ranked")
    # The number of the task is in the upper bits.
    task, place = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()
    before, start = [], 0
    for task_id, n in sorted(map(tuple, counts)):
        before.append((task_id, start))
        start += n
    starts = df.sparkSession.createDataFrame(before, "__task long, __before long")
    return (placed.withColumn("__task", task).join(F.broadcast(starts), "__task")
            .withColumn("rank", F.col("__before") + place + 1)
            .drop("__task", "__before", "__place"))


def tie_columns(df: DataFrame, tie: Sequence[str] | None = None) -> list[str]:
    """Columns that settle equal metrics: those asked for, else the id and title if present."""
    return list(tie) if tie is not None else [c for c in ("id", "title") if c in df.columns]


def rank_by(df: DataFrame, metric: str, ascending: bool = False, n: int = 10,
            where: Column | None = None, columns: Sequence[str] | None = None,
            tie: Sequence[str] | None = None) -> DataFrame:
    """The `n` rows with the highest (or lowest) non-null metric, numbered by `rank`.

    `where` may use the derived metric.  An unknown metric gives an empty (rank, title) frame.
    """
    rows = with_metrics(df, "release_year", metric)
    if metric not in rows.columns:
        return df.sparkSession.createDataFrame([], "rank int, title string")
    if where is not None:
        rows = rows.filter(where)
    direction = F.asc if ascending else F.desc
    order = [direction(metric), *[F.asc(c) for c in tie_columns(df, tie)]]
    ranked = take_ranked(rows.filter(F.col(metric).isNotNull()), order, n)
    if columns is None:
        context = [c for c in CONTEXT_COLUMNS.get(metric, ["release_year"]) if c in rows.columns]
        columns = dict.fromkeys(["rank", "title", metric, *context])
    return ranked.select(*columns)


class Ranking(NamedTuple):
    metric: str
    ascending: bool = False
    where: Callable[[], Column] | None = None


def _enough_budget() -> Column:
    return F.col("budget_musd") >= 10


def _enough_votes() -> Column:
    return F.col("vote_count") >= 10


RANKINGS = {
    "top_revenue": Ranking("revenue_musd"),
    "bottom_revenue": Ranking("revenue_musd", ascending=True),
    "top_budget": Ranking("budget_musd"),
    "bottom_budget": Ranking("budget_musd", ascending=True),
    "top_profit": Ranking("profit_musd"),
    "bottom_profit": Ranking("profit_musd", ascending=True),
    "top_roi": Ranking("roi", where=_enough_budget),
    "bottom_roi": Ranking("roi", ascending=True, where=_enough_budget),
    "most_voted": Ranking("vote_count"),
    "top_rated": Ranking("vote_average", where=_enough_votes),
    "bottom_rated": Ranking("vote_average", ascending=True, where=_enough_votes),
    "most_popular": Ranking("popularity"),
}


def ranking(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    """One of the named rankings in RANKINGS."""
    preset = RANKINGS[name]
    where = preset.where() if preset.where else None
    return rank_by(df, preset.metric, preset.ascending, n, where)


def best_value(df: DataFrame, n: int = 10, min_votes: int = 10) -> DataFrame:
    """Lowest budget per rating point among reliably rated titles."""
    rating = F.col("vote_average")
    priced = df.withColumn("budget_per_point", F.when(rating > 0, F.col("budget_musd") / rating))
    return rank_by(priced, "budget_per_point", ascending=True, n=n,
                   where=F.col("vote_count") >= min_votes,
                   columns=["rank", "title", "budget_per_point", "budget_musd", "vote_average",
                            "vote_count"])


def top_standalone_revenue(df: DataFrame, n: int = 10) -> DataFrame:
    return rank_by(df, "revenue_musd", n=n, where=F.col("collection_name").isNull())
