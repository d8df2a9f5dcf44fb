"""Every registered query against DuckDB, and the shape of its plan."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from titlelens.operators import profile
from titlelens.operators.clean import clean
from titlelens.plans.catalog import clean_titles, raw_titles
from titlelens.plans.oracle import ORACLE
from titlelens.plans.queries import QUERIES
from titlelens.sources.records import read_records

DATA = os.environ.get("TITLELENS_DATA", "/root/testdata/sf0.01")
# Those of the library proper; the ones of the llm subpackage have tests of their own.


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("part", "supplier", "orders", "lineitem", "nation", "region"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "date": "DATE"}


def test_all_queries_have_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    wanted = duck.sql(ORACLE[name])
    columns = sorted(wanted.columns)
    assert sorted(df.columns) == columns
    assert {f.name: SPARK_TYPES[f.dataType.simpleString()] for f in df.schema} == dict(
        zip(wanted.columns, map(str, wanted.types)))
    places = [wanted.columns.index(c) for c in columns]
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert got, "a query without rows compares nothing"
    assert _sorted(got) == _sorted([tuple(r[i] for i in places) for r in wanted.fetchall()])


def test_one_csv_file_holds_the_whole_catalog(spark):
    df = QUERIES["roundtrip_one_csv"](spark, DATA)
    titles = clean_titles(spark, DATA)
    assert len(df.inputFiles()) == 1
    assert df.columns == titles.columns and df.count() == titles.count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["rank", "title", "roi"] and 0 < df.count() <= 10


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("roundtrip", "land"))])
def test_no_cartesian_products(spark, name):
    plan = _plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("rank_", "top_"))])
def test_rankings_are_top_k(spark, name):
    plan = _plan(QUERIES[name](spark, DATA))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_unused_pieces_are_not_read(spark):
    titles = clean_titles(spark, DATA)
    plan = _plan(titles.select("title", "revenue_musd"))
    read = set(re.findall(r"/(\w+)\.parquet", plan))
    assert read == {"part", "lineitem"}
    read = set(re.findall(r"/(\w+)\.parquet", _plan(titles.select("release_year"))))
    assert read == {"part", "lineitem", "orders"}
    read = set(re.findall(r"/(\w+)\.parquet", _plan(titles.select("director"))))
    assert read == {"part", "lineitem", "supplier"}


def test_cleaning_adds_no_shuffle_of_its_own(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(clean_titles(spark, DATA).select("title", "revenue_musd"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Parts and item sums meet on the part; ids, some of them null, are dealt out once.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3


def test_no_shuffle_carries_the_credits(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(clean(read_records(spark, str(tmp_path))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan[:plan.rindex("Exchange hashpartitioning")]
    assert "credits" not in above and "credits" in plan


def test_audit_counts_in_a_hash(spark):
    assert "SortAggregate" not in _plan(QUERIES["clean_audit"](spark, DATA))


def test_cast_holds_every_supplier(spark):
    pairs = spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_partkey", "l_suppkey").distinct()
    held = raw_titles(spark, DATA).filter("status = 'Released' or id % 10 != 0").dropDuplicates(["id"])
    seen = held.filter("credits.cast is not null").selectExpr("id", "size(credits.cast) n")
    wanted = pairs.groupBy("l_partkey").count()
    off = seen.join(wanted, seen["id"] == wanted["l_partkey"]).filter("n != count")
    assert off.isEmpty() and not seen.isEmpty()


def test_correlation_is_one_scan(spark):
    plan = _plan(profile.correlation_matrix(spark.read.parquet(f"{DATA}/lineitem.parquet"),
                                            ["l_quantity", "l_tax", "l_discount"]))
    assert plan.count("FileScan") == 1
    assert _plan(QUERIES["correlation"](spark, DATA)).count("lineitem.parquet") == 1


def test_full_profile_reads_the_catalog_once(spark):
    plan = _plan(QUERIES["full_profile"](spark, DATA))
    assert "lineitem.parquet" not in plan and "FileScan" in plan
