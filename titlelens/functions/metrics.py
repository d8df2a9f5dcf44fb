"""Metrics that are derived on demand and never stored in the clean catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRANCHISE, STANDALONE = "Franchise", "Standalone"


def profit() -> Column:
    return F.col("revenue_musd") - F.col("budget_musd")


def roi() -> Column:
    """Return on investment in percent; null where the budget is null, zero or negative."""
    budget = F.col("budget_musd")
    return F.when(budget > 0, profit() / budget * 100)


def release_year() -> Column:
    # try_cast takes a date, a timestamp or text, and gives null for text that is no date.
    return F.year(F.col("release_date").try_cast("date"))


def title_kind(collection: str = "collection_name") -> Column:
    return F.when(F.col(collection).isNull(), STANDALONE).otherwise(FRANCHISE)


# metric -> (columns it needs, expression)
_DERIVED = {
    "profit_musd": ({"revenue_musd", "budget_musd"}, profit),
    "roi": ({"revenue_musd", "budget_musd"}, roi),
    "release_year": ({"release_date"}, release_year),
}


def with_metrics(df: DataFrame, *names: str) -> DataFrame:
    """Add the named derived metrics, skipping those present already or not computable."""
    have = set(df.columns)
    missing = {
        name: _DERIVED[name][1]()
        for name in names
        if name in _DERIVED and name not in have and _DERIVED[name][0] <= have
    }
    return df.withColumns(missing) if missing else df


def valid_financials() -> Column:
    """Budget and revenue both known and positive."""
    return (F.col("budget_musd") > 0) & (F.col("revenue_musd") > 0)


def reliable_rating(min_votes: int = 10) -> Column:
    return (F.col("vote_count") >= min_votes) & F.col("vote_average").isNotNull()
