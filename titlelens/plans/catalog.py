"""A catalog of titles over the star-schema test tables: parts as titles, suppliers as people.

The raw form is nested, with planted blanks, placeholders, unreleased titles and duplicates, so
that every cleaning rule has work to do.  Each piece hangs on the title by a left join on a key
that is unique on the other side, so Catalyst drops a piece whose columns a query does not use.

It is one SQL text: a frame of several hundred Column calls takes longer to put together than
most queries over it take to run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlelens.operators.clean import clean, row_order

# Money in whole cents and counts per part are exact in any order of the rows.  A team holds
# every supplier of a part once, by key; it is as long as the part has suppliers.  Copies: every
# tenth title is there twice; every twentieth copy was withdrawn, every thirtieth has another
# title, and every seventieth title was released only as a copy.
RAW_SQL = """
WITH sales AS (
  SELECT l_partkey AS part,
         sum(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5)) AS net_cents,
         sum(CAST(l_quantity AS bigint)) AS quantity,
         sum(floor(l_discount * 100 + 0.5)) AS discount_points,
         count(*) AS items, min(l_orderkey) AS first_order
  FROM {lineitem} GROUP BY l_partkey),
first_dates AS (
  SELECT o_orderkey AS first_order, min(o_orderdate) AS first_date
  FROM {orders} GROUP BY o_orderkey),
people AS (
  SELECT team_part, array_sort(collect_list(named_struct('s_suppkey', s_suppkey,
                                                         's_name', s_name))) AS team
  FROM (SELECT DISTINCT l_partkey AS team_part, l_suppkey FROM {lineitem})
  JOIN {supplier} ON l_suppkey = s_suppkey GROUP BY team_part),
countries AS (
  SELECT CAST(n_nationkey AS bigint) AS made_in, min(n_name) AS n_name, min(r_name) AS r_name
  FROM {nation} LEFT JOIN {region} ON n_regionkey = r_regionkey GROUP BY n_nationkey),
titles AS (
  SELECT p.*, sales.*, first_date, team, n_name, r_name, p_partkey AS key, p_size AS size,
         floor(p_retailprice * 100 + 0.5) AS retail_cents,
         CASE WHEN p_partkey % 89 != 0 THEN
           CASE WHEN p_partkey % 53 = 0 THEN 'nan'
                ELSE concat_ws(' #', p_name, CAST(p_partkey AS string)) END END AS base_title,
         CASE WHEN p_size % 11 = 0 THEN '0'
              ELSE CAST(CAST(p_size AS bigint) * 3 AS string) END AS base_runtime
  FROM {part} p
  LEFT JOIN sales ON p_partkey = part
  LEFT JOIN first_dates ON sales.first_order = first_dates.first_order
  LEFT JOIN people ON p_partkey = team_part
  LEFT JOIN countries ON p_partkey % 25 = made_in),
records AS (
  SELECT *, explode(sequence(0, CASE WHEN key % 10 = 0 THEN 1 ELSE 0 END)) AS copy FROM titles)
SELECT
  CASE WHEN key % 97 != 0 THEN key END AS id,
  CASE WHEN copy = 1 AND key % 30 = 0 THEN concat(base_title, ' (copy)')
       ELSE base_title END AS title,
  CASE WHEN key % 41 = 0 THEN '' WHEN key % 43 = 0 THEN 'soon'
       ELSE CAST(CAST(first_date AS date) AS string) END AS release_date,
  CASE WHEN copy = 1 AND key % 20 = 0 THEN 'Rumored'
       WHEN copy = 0 AND key % 70 = 0 THEN 'Planned'
       WHEN key % 83 = 0 THEN NULL
       WHEN size = 50 THEN 'Rumored' ELSE 'Released' END AS status,
  'tt0' AS imdb_id,
  CASE WHEN size <= 25 THEN named_struct(
    'id', CAST(size AS bigint),
    'name', CASE WHEN size = 20 THEN 'nan' ELSE concat(p_brand, ' Collection') END)
  END AS belongs_to_collection,
  CASE WHEN key % 37 = 0 THEN CAST(array() AS array<struct<name: string>>)
       WHEN key % 59 = 0 THEN NULL
       ELSE transform(concat(split(p_name, ' '), array(p_type)), w -> named_struct('name', w))
  END AS genres,
  array(named_struct('name', n_name)) AS production_countries,
  array(named_struct('name', p_brand), named_struct('name', concat('Studio ', p_type)))
    AS production_companies,
  array(named_struct('name', r_name), named_struct('name', 'LATIN')) AS spoken_languages,
  lower(substring(r_name, 1, 2)) AS original_language,
  named_struct('keywords', array(named_struct('name', p_brand), named_struct('name', p_type)))
    AS keywords,
  CASE WHEN key % 61 != 0 THEN named_struct(
    'cast', transform(team, p -> named_struct('name', p.s_name)),
    'crew', transform(team, p -> named_struct(
      'job', CASE WHEN p.s_suppkey % 7 = 0 THEN 'Director' ELSE 'Writer' END,
      'name', p.s_name))) END AS credits,
  CASE WHEN size % 10 = 0 THEN 0 ELSE net_cents END AS revenue,
  CASE WHEN size % 7 = 0 THEN 0 ELSE quantity * retail_cents * (1 + size % 4) END AS budget,
  CASE WHEN size % 13 = 0 THEN concat(base_runtime, '.0') WHEN size % 12 = 0 THEN 'unknown'
       ELSE base_runtime END AS runtime,
  CASE WHEN size % 9 = 0 THEN
         get(array('No Overview', 'n/a', 'No Data', 'nan'), CAST(size / 9 AS int) % 4)
       ELSE p_name END AS overview,
  CASE WHEN size % 8 = 0 THEN 'nan' WHEN size % 15 = 0 THEN 'n/a' ELSE p_brand END AS tagline,
  items AS vote_count,
  discount_points / items AS vote_average,
  CAST(quantity AS double) AS popularity
FROM records
"""
# The columns read.  A declared schema spares a job per table that looks for it.
TABLES = {
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "supplier": "s_suppkey long, s_name string",
    "orders": "o_orderkey long, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, "
                "l_extendedprice double, l_discount double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw records, one or two per part, with dirty values that each rule has to mend.

    Numbers and dates that may be dirty are text, as in a landed file.
    """
    return spark.sql(RAW_SQL, **{name: spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
                                 for name, schema in TABLES.items()})


def clean_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned catalog.  Copies planted above differ in status and title at most."""
    raw = raw_titles(spark, sf_dir)
    return clean(raw, row_order(raw, whole=False))
