import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("titlelens-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.maxMetadataStringLength", "2000")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "4g")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def money_titles(spark):
    """A success, a small title with few votes, a loss, and one of unknown revenue that shares its
    rating with the first and its popularity with the third."""
    return spark.createDataFrame(
        [("Harbour", 90.5, 30.0, 220, 7.25, 14.0, "2011-03-09"),
         ("Lantern", 12.0, 4.0, 6, 9.5, 2.5, "2013-07-21"),
         ("Quarry", 6.0, 48.0, 75, 3.5, 6.5, "2012-11-02"),
         ("Tundra", None, 16.0, 40, 7.25, 6.5, None)],
        "title string, revenue_musd double, budget_musd double, vote_count long, "
        "vote_average double, popularity double, release_date string")


@pytest.fixture(scope="session")
def series_titles(spark):
    """Three titles of one series by two directors, and two that stand alone, one of them without
    a director; two returns are equal."""
    return spark.createDataFrame(
        [("Delta One", "Delta", "Ines Roy", 80.0, 40.0, 6.5, 9.0, 300),
         ("Delta Two", "Delta", "Ines Roy", 120.0, 50.0, 7.5, 11.0, 420),
         ("Delta Three", "Delta", "Omar Lund", 55.0, 60.0, 5.5, 7.0, 150),
         ("Ember", None, "Omar Lund", 33.0, 22.0, 8.25, 4.0, 90),
         ("Fjord", None, None, 70.0, 35.0, 6.0, 5.0, 60)],
        "title string, collection_name string, director string, revenue_musd double, "
        "budget_musd double, vote_average double, popularity double, vote_count long")


def column(df, name):
    return [row[name] for row in df.collect()]
