import pytest
from pyspark.sql import functions as F

from titlelens.operators import rollup as r

from conftest import column


def test_compare_franchises(series_titles):
    standalone, franchise = r.compare_franchises(series_titles).collect()
    assert (franchise.is_franchise, standalone.is_franchise) == ("Franchise", "Standalone")
    assert (franchise.movie_count, standalone.movie_count) == (3, 2)
    assert (franchise.mean_revenue_musd, standalone.mean_revenue_musd) == (85.0, 51.5)
    # An element of the data (the lower median), not a value between two.
    assert (franchise.median_roi, standalone.median_roi) == (100.0, 50.0)


@pytest.mark.parametrize("exact", [True, False])
def test_compare_without_returns(series_titles, exact):
    """A kind without any known return keeps its row, with a null median."""
    free = series_titles.withColumn("budget_musd", F.when(F.col("collection_name").isNull(), 0.0)
                                    .otherwise(F.col("budget_musd")))
    standalone, franchise = r.compare_franchises(free, exact).collect()
    assert (standalone.movie_count, standalone.median_roi) == (2, None)
    assert (franchise.movie_count, franchise.median_roi) == (3, 100.0)
    assert standalone.mean_budget_musd == 0.0


def test_top_franchises(series_titles):
    (row,) = r.top_franchises(series_titles).collect()
    assert (row.rank, row.movie_count, row.total_revenue_musd) == (1, 3, 255.0)
    assert r.top_franchises(series_titles).columns == [
        "rank", "collection_name", "movie_count", "total_budget_musd", "mean_budget_musd",
        "total_revenue_musd", "mean_revenue_musd", "mean_rating", "mean_vote_count"]


def test_top_directors(series_titles):
    rows = r.top_directors(series_titles).collect()
    assert [(x.director, x.movie_count, x.total_revenue_musd) for x in rows] == [
        ("Ines Roy", 2, 200.0), ("Omar Lund", 2, 88.0)]
    one_more = series_titles.union(series_titles.filter("title = 'Ember'"))
    assert column(r.top_directors(one_more, min_titles=3), "director") == ["Omar Lund"]
    assert column(r.top_directors(series_titles, n=1, sort_by="mean_rating"), "director") == [
        "Ines Roy"]


@pytest.mark.parametrize("sort_by", r.GROUP_MEASURES)
def test_equal_groups_are_ranked_by_key(series_titles, sort_by):
    twice = series_titles.union(series_titles.replace("Ines Roy", "Ada Berg", "director"))
    some = twice.filter("director in ('Ines Roy', 'Ada Berg')")
    rows = r.top_directors(some, sort_by=sort_by).collect()
    assert [(x.rank, x.director) for x in rows] == [(1, "Ada Berg"), (2, "Ines Roy")]


def _listed(spark):
    return spark.createDataFrame(
        [("A", 2002, "The Saga", "Jane Doe", "x|y"), ("B", 2001, "The Saga II", "jane", "x"),
         ("C", None, "the saga", "Joe", ""), ("D", 2000, None, None, None)],
        "title string, release_year int, collection_name string, director string, genres string"
    ).selectExpr("*", "1.0D budget_musd", "2.0D revenue_musd", "3.0D vote_average",
                 "4L vote_count", "5.0D popularity")


def test_details(spark):
    titles = _listed(spark)
    series = r.franchise_details(titles, "Saga")
    assert column(series, "title") == ["B", "A"]
    assert series.columns == ["title", "release_year", "budget_musd", "revenue_musd",
                              "vote_average", "vote_count", "popularity", "director",
                              "collection_name"]
    person = r.director_details(titles, "JANE")
    assert column(person, "title") == ["B", "A"]
    assert person.columns[-2:] == ["genres", "collection_name"]


def test_token_counts(spark):
    rows = r.token_counts(_listed(spark)).collect()
    assert [(x.genre, x["count"]) for x in rows] == [("x", 2), ("", 1), ("y", 1)]
    assert column(r.token_counts(_listed(spark), n=1), "genre") == ["x"]
    assert column(r.token_counts(_listed(spark), drop_empty=True), "genre") == ["x", "y"]


def test_titles_per_year(spark):
    titles = _listed(spark)
    assert column(r.titles_per_year(titles), "release_year") == [2000, 2001, 2002, None]
    assert column(r.titles_per_year(titles, years=2), "release_year") == [2001, 2002]


def test_genres_by_revenue_and_year(spark):
    titles = _listed(spark)
    rows = r.top_genres_by_revenue(titles).collect()
    assert [(x.rank, x.genre, x.total_revenue_musd) for x in rows] == [
        (1, "x", 4.0), (2, "", 2.0), (3, "y", 2.0)]
    trend = r.genre_year_trend(titles).collect()
    assert [(x.genre, x.release_year, x.movie_count) for x in trend] == [
        ("x", 2001, 1), ("x", 2002, 1), ("y", 2002, 1)]


def test_row_count(spark):
    assert r.row_count(spark.range(7)).first().row_count == 7
