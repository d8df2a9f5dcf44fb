import pytest
from pyspark.sql import functions as F

from titlelens.operators import rank

from conftest import column


def test_top_revenue(money_titles):
    rows = rank.ranking(money_titles, "top_revenue", n=2).collect()
    assert [(r.rank, r.title) for r in rows] == [(1, "Harbour"), (2, "Lantern")]


def test_roi_needs_a_budget_of_ten(money_titles):
    rows = rank.ranking(money_titles, "top_roi").collect()
    assert [r.title for r in rows] == ["Harbour", "Quarry"]
    assert [r.roi for r in rows] == pytest.approx([60.5 / 30 * 100, -87.5])
    assert column(rank.ranking(money_titles, "bottom_roi"), "title") == ["Quarry", "Harbour"]


def test_rating_needs_ten_votes(money_titles):
    assert column(rank.ranking(money_titles, "top_rated"), "title") == [
        "Harbour", "Tundra", "Quarry"]
    assert column(rank.ranking(money_titles, "bottom_rated"), "title") == [
        "Quarry", "Harbour", "Tundra"]


@pytest.mark.parametrize("name,titles", [
    ("bottom_revenue", ["Quarry", "Lantern", "Harbour"]),
    ("top_budget", ["Quarry", "Harbour", "Tundra", "Lantern"]),
    ("bottom_budget", ["Lantern", "Tundra", "Harbour", "Quarry"]),
    ("top_profit", ["Harbour", "Lantern", "Quarry"]),
    ("bottom_profit", ["Quarry", "Lantern", "Harbour"]),
    ("most_voted", ["Harbour", "Quarry", "Tundra", "Lantern"]),
    ("most_popular", ["Harbour", "Quarry", "Tundra", "Lantern"]),
])
def test_other_rankings(money_titles, name, titles):
    assert column(rank.ranking(money_titles, name), "title") == titles


@pytest.mark.parametrize("name,columns", [
    ("top_revenue", ["rank", "title", "revenue_musd", "release_year", "budget_musd"]),
    ("top_profit", ["rank", "title", "profit_musd", "release_year", "budget_musd",
                    "revenue_musd"]),
    ("top_roi", ["rank", "title", "roi", "release_year", "budget_musd", "revenue_musd"]),
    ("top_rated", ["rank", "title", "vote_average", "release_year", "vote_count"]),
    ("most_popular", ["rank", "title", "popularity", "release_year", "vote_average"]),
])
def test_shown_columns(money_titles, name, columns):
    assert rank.ranking(money_titles, name).columns == columns


def test_year_comes_from_the_date(money_titles):
    assert rank.ranking(money_titles, "top_revenue").first().release_year == 2011


def test_unknown_metric_gives_an_empty_frame(money_titles):
    empty = rank.rank_by(money_titles, "nothing")
    assert empty.count() == 0 and empty.dtypes == [("rank", "int"), ("title", "string")]


def test_other_metric_and_columns(money_titles):
    df = money_titles.withColumn("score", F.length("title"))
    assert rank.rank_by(df, "score").columns == ["rank", "title", "score", "release_year"]
    assert rank.rank_by(df, "score", columns=["title", "rank"]).columns == ["title", "rank"]


def test_ties_follow_the_tie_columns(spark):
    df = spark.createDataFrame([(i, f"t{9 - i}", 1.0) for i in range(6)],
                               "id long, title string, score double")
    assert column(rank.rank_by(df, "score", n=3), "title") == ["t9", "t8", "t7"]
    assert column(rank.rank_by(df, "score", n=3, tie=["title"]), "title") == ["t4", "t5", "t6"]
    assert column(rank.rank_by(df.drop("id"), "score", n=2), "title") == ["t4", "t5"]


def test_nulls_are_left_out_and_nan_is_the_largest(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", float("nan"))],
                               "title string, score double")
    assert column(rank.rank_by(df, "score"), "title") == ["c", "a"]


def test_zero_budget_has_no_roi(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 1.0, None), ("c", 3.0, 2.0)],
                               "title string, revenue_musd double, budget_musd double")
    assert [(r.title, r.roi) for r in rank.rank_by(df, "roi").collect()] == [("c", 50.0)]


def test_best_value_and_standalone(money_titles, series_titles):
    assert column(rank.best_value(money_titles), "title") == ["Tundra", "Harbour", "Quarry"]
    zero = money_titles.withColumn("vote_average", F.lit(0.0))
    assert rank.best_value(zero).count() == 0
    assert column(rank.top_standalone_revenue(series_titles), "title") == ["Fjord", "Ember"]


def test_plan_is_a_top_k(money_titles):
    plan = rank.ranking(money_titles, "top_revenue")._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan.split("Physical Plan")[1]
