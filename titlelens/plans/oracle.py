"""The same results in flat SQL for DuckDB, written from the tables and not from the Spark plans."""

from __future__ import annotations

CATALOG = """
WITH sales AS (
  SELECT l_partkey AS part,
         CAST(sum(CAST(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) AS BIGINT)) AS BIGINT) AS net_cents,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
         CAST(sum(CAST(floor(l_discount * 100 + 0.5) AS BIGINT)) AS BIGINT) AS discount_points,
         count(*) AS items,
         min(l_orderkey) AS first_order
  FROM lineitem GROUP BY l_partkey),
team AS (
  SELECT part, s_suppkey, s_name,
         row_number() OVER (PARTITION BY part ORDER BY s_suppkey) AS pos
  FROM (SELECT DISTINCT l_partkey AS part, l_suppkey FROM lineitem)
  JOIN supplier ON s_suppkey = l_suppkey),
people AS (
  SELECT part,
         string_agg(s_name, '|' ORDER BY pos) FILTER (WHERE pos <= 5) AS "cast",
         CAST(count(*) AS INTEGER) AS team_size,
         arg_min(s_name, pos) FILTER (WHERE s_suppkey % 7 = 0) AS director
  FROM team GROUP BY part),
parts AS (
  SELECT *, 3 * p_size AS minutes,
         CASE WHEN p_partkey % 41 <> 0 AND p_partkey % 43 <> 0 THEN CAST(o_orderdate AS DATE) END AS released_on
  FROM part LEFT JOIN sales ON sales.part = p_partkey
  LEFT JOIN orders ON o_orderkey = first_order
  LEFT JOIN people ON people.part = p_partkey AND p_partkey % 61 <> 0
  LEFT JOIN nation ON n_nationkey = p_partkey % 25
  LEFT JOIN region ON r_regionkey = n_regionkey),
raw AS (
  SELECT CASE WHEN p_partkey % 97 <> 0 THEN p_partkey END AS id,
         CASE WHEN p_partkey % 89 = 0 THEN NULL
              ELSE CASE WHEN p_partkey % 53 = 0 THEN 'nan' ELSE p_name || ' #' || p_partkey END
                   || CASE WHEN nth = 1 AND p_partkey % 30 = 0 THEN ' (copy)' ELSE '' END
         END AS title,
         CASE WHEN p_size % 8 <> 0 AND p_size % 15 <> 0 THEN p_brand END AS tagline,
         released_on AS release_date,
         CASE WHEN p_partkey % 37 = 0 THEN [] WHEN p_partkey % 59 = 0 THEN NULL
              ELSE list_append(string_split(p_name, ' '), p_type) END AS words,
         CASE WHEN p_size = 20 THEN 'nan' WHEN p_size <= 25 THEN p_brand || ' Collection' END AS collection_text,
         lower(left(r_name, 2)) AS original_language,
         CASE WHEN p_size % 7 <> 0 THEN quantity * CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) * (1 + p_size % 4) END AS budget,
         CASE WHEN p_size % 10 <> 0 THEN net_cents END AS revenue,
         p_brand || '|Studio ' || p_type AS production_companies,
         coalesce(n_name, '') AS production_countries,
         items AS vote_count,
         CAST(discount_points AS DOUBLE) / items AS vote_average,
         CAST(quantity AS DOUBLE) AS popularity,
         CASE WHEN p_size % 11 <> 0 AND (p_size % 12 <> 0 OR p_size % 13 = 0) THEN CAST(minutes AS BIGINT) END AS runtime,
         CASE WHEN p_size % 9 <> 0 THEN p_name END AS overview,
         coalesce(r_name || '|', '') || 'LATIN' AS spoken_languages,
         "cast", team_size AS cast_size, director, team_size AS crew_size,
         CAST(year(released_on) AS INTEGER) AS release_year,
         p_brand || '|' || p_type AS keywords,
         CASE WHEN nth = 1 AND p_partkey % 20 = 0 THEN 'Rumored'
              WHEN nth = 0 AND p_partkey % 70 = 0 THEN 'Planned'
              WHEN p_partkey % 83 = 0 THEN NULL
              WHEN p_size = 50 THEN 'Rumored' ELSE 'Released' END AS status
  FROM parts, range(2) AS copy(nth) WHERE nth = 0 OR p_partkey % 10 = 0),
titles AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY status IS DISTINCT FROM 'Released', title IS NULL, status NULLS FIRST, title NULLS FIRST) = 1),
clean AS (
  SELECT id, nullif(title, 'nan') AS title, tagline, release_date,
         array_to_string(list_sort(words), '|') AS genres,
         nullif(collection_text, 'nan') AS collection_name, original_language,
         CAST(budget AS DOUBLE) / 1000000 AS budget_musd,
         CAST(revenue AS DOUBLE) / 1000000 AS revenue_musd, production_companies,
         production_countries, vote_count, vote_average, popularity,
         runtime, overview, spoken_languages, "cast", cast_size, director, crew_size,
         release_year, keywords
  FROM titles WHERE status = 'Released' AND id IS NOT NULL AND title IS NOT NULL),
money AS (
  SELECT *, revenue_musd - budget_musd AS profit_musd,
         CASE WHEN budget_musd > 0 THEN (revenue_musd - budget_musd) / budget_musd * 100 END AS roi
  FROM clean),
by_genre AS (SELECT *, unnest(string_split(genres, '|')) AS genre FROM money)
"""

_MEASURES = """count(*) AS movie_count,
  round(sum(budget_musd), 6) AS total_budget_musd, round(avg(budget_musd) + 1e-9, 4) AS mean_budget_musd,
  round(sum(revenue_musd), 6) AS total_revenue_musd, round(avg(revenue_musd) + 1e-9, 4) AS mean_revenue_musd,
  round(avg(vote_average) + 1e-9, 4) AS mean_rating, round(avg(vote_count) + 1e-9, 4) AS mean_vote_count"""

_NUMERIC = ["budget_musd", "revenue_musd", "runtime", "vote_average", "vote_count", "popularity",
            "cast_size", "crew_size"]
_CORRELATED = _NUMERIC[:6]
_CLEAN_TYPES = {
    "id": "bigint", "title": "string", "tagline": "string", "release_date": "date",
    "genres": "string", "collection_name": "string", "original_language": "string",
    "budget_musd": "double", "revenue_musd": "double", "production_companies": "string",
    "production_countries": "string", "vote_count": "bigint", "vote_average": "double",
    "popularity": "double", "runtime": "bigint", "overview": "string",
    "spoken_languages": "string", "cast": "string", "cast_size": "int", "director": "string",
    "crew_size": "int", "release_year": "int", "keywords": "string"}
_MONEY = ["release_year", "budget_musd", "revenue_musd"]
_VOTES = ["release_year", "vote_average", "vote_count"]


def _show(columns: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def _rank(metric: str, context: list[str], ascending: bool = False, where: str = "true",
          n: int = 10, source: str = "money") -> str:
    columns = list(dict.fromkeys(["title", metric, *context]))
    order = f"{metric} {'ASC' if ascending else 'DESC'}, id"
    return f"""{CATALOG} SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, {_show(columns)}
FROM {source} WHERE {metric} IS NOT NULL AND {where} ORDER BY {order} LIMIT {n}"""


def _filtered(where: str, columns: list[str], tail: str = "") -> str:
    return f"{CATALOG} SELECT {_show(columns)} FROM clean WHERE {where} {tail}"


def _top_groups(key: str, n: int, sort_by: str, having: str = "true",
                source: str = "clean") -> str:
    raw_sort = {"total_revenue_musd": "sum(revenue_musd)", "mean_rating": "avg(vote_average)",
                "movie_count": "count(*)"}[sort_by]
    return f"""{CATALOG} SELECT CAST(row_number() OVER (ORDER BY {raw_sort} DESC NULLS LAST, {key}) AS INTEGER) AS rank,
  {key}, {_MEASURES} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING {having}
ORDER BY rank LIMIT {n}"""


def _all_of(parts: list[str]) -> str:
    return f"{CATALOG} " + " UNION ALL ".join(parts)


def _statistics() -> str:
    return _all_of([f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 8) AS mean,
  round(stddev_samp({c}), 8) AS std, round(CAST(min({c}) AS DOUBLE), 8) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 8) AS p25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 8) AS median,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 8) AS p75,
  round(CAST(max({c}) AS DOUBLE), 8) AS max FROM clean""" for c in _NUMERIC])


def _summary() -> str:
    rows = {"count": "CAST(count({c}) AS DOUBLE)", "mean": "round(avg({c}), 6)",
            "stddev": "round(stddev_samp({c}), 6)", "min": "round(CAST(min({c}) AS DOUBLE), 6)",
            "25%": "round(CAST(quantile_disc({c}, 0.25) AS DOUBLE), 6)",
            "50%": "round(CAST(quantile_disc({c}, 0.5) AS DOUBLE), 6)",
            "75%": "round(CAST(quantile_disc({c}, 0.75) AS DOUBLE), 6)",
            "max": "round(CAST(max({c}) AS DOUBLE), 6)"}
    return _all_of([f"SELECT '{name}' AS summary, " + ", ".join(
        f"{value.format(c=c)} AS {c}" for c in _NUMERIC) + " FROM clean"
        for name, value in rows.items()])


def _histogram() -> str:
    values = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS v FROM money WHERE {c} IS NOT NULL"""
        for c in [*_NUMERIC, "profit_musd"])
    return f"""{CATALOG}, vals AS ({values}),
ranges AS (
  SELECT "column", min(v) - CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS lo,
         max(v) + CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS hi FROM vals GROUP BY 1),
bins AS (
  SELECT "column", CAST(k AS INTEGER) AS bin, lo + (k - 1) * ((hi - lo) / 30) AS bin_start,
         CASE WHEN k = 30 THEN hi ELSE lo + k * ((hi - lo) / 30) END AS bin_end
  FROM ranges, range(1, 31) AS g(k))
SELECT b."column", bin, bin_start, bin_end,
       count(v) AS count
FROM bins b LEFT JOIN vals ON vals."column" = b."column" AND v >= bin_start
     AND (v < bin_end OR (bin = 30 AND v <= bin_end))
GROUP BY ALL"""


def _correlation() -> str:
    return _all_of([f"""SELECT '{x}' AS "column", """ + ", ".join(
        f"round(CAST({'1' if x == y else f'corr({x}, {y})'} AS DOUBLE), 6) AS {y}"
        for y in _CORRELATED) + " FROM clean" for x in _CORRELATED])


def _null_profile() -> str:
    return _all_of([f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS null_count,
  round_even((count(*) - count("{c}")) / count(*) * 100, 2) AS null_percentage FROM clean"""
                    for c in _CLEAN_TYPES])


def _overview() -> str:
    return _all_of([f"""SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS "column", '{t}' AS type,
  count(*) AS row_count, CAST({len(_CLEAN_TYPES)} AS INTEGER) AS col_count FROM clean"""
                    for i, (c, t) in enumerate(_CLEAN_TYPES.items(), start=1)])


_QUALITY = f"""{CATALOG}, q AS (
  SELECT count(*) AS n, {' + '.join(f'count("{c}")' for c in _CLEAN_TYPES)} AS filled,
         count(*) FILTER (WHERE budget_musd > 0 AND revenue_musd > 0) AS financial,
         count(*) FILTER (WHERE vote_count >= 10 AND vote_average IS NOT NULL) AS rated
  FROM clean)
SELECT n AS total_rows, CAST({len(_CLEAN_TYPES)} AS INTEGER) AS total_columns,
       n * {len(_CLEAN_TYPES)} AS total_cells, filled AS filled_cells,
       n * {len(_CLEAN_TYPES)} - filled AS missing_cells,
       round(filled / (n * {len(_CLEAN_TYPES)}) * 100 + 1e-9, 4) AS completeness_pct,
       financial AS valid_financial_rows, round(financial / n * 100 + 1e-9, 4) AS valid_financial_pct,
       rated AS reliable_rating_rows, round(rated / n * 100 + 1e-9, 4) AS reliable_rating_pct
FROM q"""

_BOXES = f"""{CATALOG}, points AS (
  SELECT genre, roi FROM by_genre WHERE roi IS NOT NULL AND genre IN (
    SELECT genre FROM by_genre WHERE roi IS NOT NULL GROUP BY genre
    ORDER BY count(*) DESC, genre LIMIT 10)),
box AS (
  SELECT genre, quantile_cont(roi, 0.25) AS q1, quantile_cont(roi, 0.5) AS median,
         quantile_cont(roi, 0.75) AS q3 FROM points GROUP BY genre),
fenced AS (
  SELECT *, roi >= q1 - 1.5 * (q3 - q1) AND roi <= q3 + 1.5 * (q3 - q1) AS inside
  FROM points JOIN box USING (genre))"""

_LISTED = ["id", "title", "genres", "cast", "director", "release_year", "vote_average"]
_CLEAN = f"{CATALOG} SELECT * FROM clean"
_CSV = f"{CATALOG} SELECT * REPLACE (nullif(genres, '') AS genres) FROM clean"
_BARS = """round(avg(revenue_musd) + 1e-9, 4) AS mean_revenue, round(avg(budget_musd) + 1e-9, 4) AS mean_budget,
  round(avg(vote_average) + 1e-9, 4) AS mean_rating"""


def _yearly(where: str) -> str:
    return f"""{CATALOG} SELECT release_year, count(*) AS movie_count,
  round(sum(revenue_musd), 6) AS total_revenue, {_BARS}
FROM clean WHERE release_year IS NOT NULL AND revenue_musd IS NOT NULL AND {where} GROUP BY 1"""


def _unlanded(shown: str) -> str:
    return f"""{CATALOG} SELECT {shown} FROM part
WHERE p_partkey NOT IN (SELECT id FROM raw WHERE status = 'Released' AND id IS NOT NULL)"""


ORACLE: dict[str, str] = {
    "clean_catalog": _CLEAN,
    "clean_audit": f"""{CATALOG} SELECT (SELECT count(*) FROM raw) AS rows_before,
  (SELECT count(*) FROM raw) - count(*) AS duplicates_removed,
  count(*) FILTER (WHERE id IS NULL OR title IS NULL) AS incomplete_removed,
  count(*) FILTER (WHERE id IS NOT NULL AND title IS NOT NULL
                   AND status IS DISTINCT FROM 'Released') AS unreleased_removed,
  (SELECT count(*) FROM clean) AS rows_after,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) AS rows_removed
FROM titles""",
    "flatten_names": f"""{CATALOG} SELECT id, array_to_string(words, '|') AS genres,
  collection_text AS collection_name, production_companies, production_countries,
  spoken_languages, keywords FROM raw""",
    "fix_types": f"""{CATALOG} SELECT id, release_date, budget, revenue, runtime,
  CAST(budget AS DOUBLE) / 1000000 AS budget_musd,
  CAST(revenue AS DOUBLE) / 1000000 AS revenue_musd, overview, tagline FROM raw""",
    "dedupe_ids": f"{CATALOG} SELECT id, title, status FROM titles",
    "people_features": f"""{CATALOG} SELECT id, "cast", cast_size, director, crew_size,
  release_year, tagline, nullif(title, 'nan') AS title FROM raw""",
    "sort_tokens": f"""{CATALOG} SELECT id, array_to_string(list_sort(words), '|') AS genres
FROM raw""",

    "landing_plan": _unlanded("p_partkey AS id"),
    "load_count": _unlanded("count(*) AS to_load"),
    "landed_inventory": f"""{CATALOG} SELECT count(*) AS landed_records,
  CAST(0 AS BIGINT) AS empty_files FROM raw WHERE status = 'Released'""",
    "quarantine": f"""{CATALOG}, told AS (
  SELECT title, CASE WHEN id IS NULL THEN 'no key' WHEN id % 17 = 0 THEN 'unreadable'
                     WHEN id % 19 = 0 THEN 'key is no number' ELSE 'good' END AS reason FROM raw)
SELECT reason, count(*) AS records, count(*) FILTER (WHERE reason <> 'good') AS with_file,
  CASE WHEN reason = 'good' THEN count(title) ELSE count(*) END AS with_text
FROM told GROUP BY reason""",
    "scan_cached": """SELECT s_suppkey AS id, s_name AS title, s_name AS genre,
  count(*) OVER () AS records FROM supplier WHERE s_suppkey % 7 = 0""",
    "merged_landings": _CLEAN,
    "clustered_years": _filtered("release_year BETWEEN 1996 AND 1998", _LISTED),
    "roundtrip_json": _CLEAN,
    "roundtrip_parquet": _CLEAN,
    "roundtrip_csv": _CSV,
    "roundtrip_one_csv": _CSV,
    "landed_by_name": "SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 7 <> 0",

    "rank_top_revenue": _rank("revenue_musd", _MONEY),
    "rank_bottom_revenue": _rank("revenue_musd", _MONEY, ascending=True),
    "rank_top_budget": _rank("budget_musd", _MONEY),
    "rank_bottom_budget": _rank("budget_musd", _MONEY, ascending=True),
    "rank_top_profit": _rank("profit_musd", _MONEY),
    "rank_bottom_profit": _rank("profit_musd", _MONEY, ascending=True),
    "rank_top_roi": _rank("roi", _MONEY, where="budget_musd >= 10"),
    "rank_bottom_roi": _rank("roi", _MONEY, ascending=True, where="budget_musd >= 10"),
    "rank_most_voted": _rank("vote_count", _VOTES),
    "rank_top_rated": _rank("vote_average", _VOTES, where="vote_count >= 10"),
    "rank_bottom_rated": _rank("vote_average", _VOTES, ascending=True, where="vote_count >= 10"),
    "rank_most_popular": _rank("popularity", ["release_year", "vote_average"]),
    "rank_top_roi_big_budget": _rank("roi", _MONEY, where="budget_musd >= 100", n=25),
    "rank_bottom_rated_many_votes": _rank("vote_average", _VOTES, ascending=True,
                                          where="vote_count >= 30"),
    "rank_all_roi": f"""{CATALOG} SELECT row_number() OVER (ORDER BY roi DESC, id) AS rank, id,
  title, roi FROM money WHERE roi IS NOT NULL""",
    "rank_all_rating": f"""{CATALOG} SELECT row_number() OVER (ORDER BY vote_average, id) AS rank,
  id, vote_average FROM clean WHERE vote_average IS NOT NULL""",
    "best_value": _rank("budget_per_point", ["budget_musd", "vote_average", "vote_count"],
                        ascending=True, where="vote_count >= 10",
                        source="(SELECT *, CASE WHEN vote_average > 0 THEN budget_musd / "
                               "vote_average END AS budget_per_point FROM money)"),
    "top_standalone_revenue": _rank("revenue_musd", _MONEY, where="collection_name IS NULL"),

    "filter_genres_all": _filtered("contains(genres, 'ring') AND contains(genres, 'small')",
                                   _LISTED),
    "filter_genres_any": _filtered("contains(genres, 'gear') OR contains(genres, 'PROMO')",
                                   _LISTED),
    "filter_genres_exact": _filtered("list_contains(string_split(genres, '|'), 'old')", _LISTED),
    "filter_actor": _filtered("""contains(lower("cast"), 'supplier#00000001')""", _LISTED),
    "filter_director": _filtered("contains(director, 'Supplier#00000000')", _LISTED),
    "filter_years": _filtered("release_year BETWEEN 1996 AND 1998", _LISTED),
    "filter_valid_financials": _filtered("budget_musd > 0 AND revenue_musd > 0",
                                         ["id", "budget_musd", "revenue_musd"]),
    "filter_reliable_rating": _filtered("vote_count >= 30 AND vote_average IS NOT NULL",
                                        ["id", "vote_count", "vote_average"]),
    "search_multi": _filtered(
        """contains(genres, 'small') AND (contains(lower("cast"), 'supplier#000000001')
  OR contains(lower("cast"), 'supplier#000000002')) AND vote_average >= 4.5 AND vote_count >= 20""",
        ["id", "title", "vote_average", "genres", "cast", "vote_count"],
        "ORDER BY clean.vote_average DESC NULLS LAST, id LIMIT 20"),
    "search_directors": _filtered(
        "lower(director) LIKE '%supplier#000000007%' OR lower(director) LIKE '%supplier#000000014%'",
        ["id", "title", "revenue_musd", "director"],
        "ORDER BY clean.revenue_musd DESC NULLS LAST, id LIMIT 20"),
    "search_preset_rating": _filtered(
        """contains(genres, 'ring') AND contains(genres, 'LARGE')
  AND contains(lower("cast"), 'supplier#00000000')""",
        ["title", "release_year", "vote_average", "vote_count", "genres", "director",
         "revenue_musd"]),
    "search_preset_runtime": _filtered(
        """contains(lower("cast"), 'supplier#00000000')
  AND contains(lower(director), 'supplier#00000000')""",
        ["title", "release_year", "runtime", "vote_average", "genres", "revenue_musd",
         "budget_musd"]),

    "indexed_search": _filtered(
        """contains(genres, 'mall') AND (contains(lower("cast"), 'supplier#000000001')
  OR contains(lower("cast"), 'supplier#000000002') OR contains("cast", '#0'))
  AND (contains(lower(director), 'supplier#000000007')
  OR contains(lower(director), 'supplier#00000001'))""", _LISTED),

    "row_count": f"{CATALOG} SELECT count(*) AS row_count FROM clean",
    "compare_franchise": f"""{CATALOG} SELECT
  CASE WHEN collection_name IS NULL THEN 'Standalone' ELSE 'Franchise' END AS is_franchise,
  count(*) AS movie_count, round(avg(revenue_musd) + 1e-9, 4) AS mean_revenue_musd,
  round(quantile_disc(roi, 0.5) + 1e-9, 4) AS median_roi, round(avg(budget_musd) + 1e-9, 4) AS mean_budget_musd,
  round(avg(popularity) + 1e-9, 4) AS mean_popularity, round(avg(vote_average) + 1e-9, 4) AS mean_rating
FROM money GROUP BY 1""",
    "top_franchises_revenue": _top_groups("collection_name", 10, "total_revenue_musd"),
    "top_franchises_rating": _top_groups("collection_name", 5, "mean_rating"),
    "top_directors_revenue": _top_groups("director", 10, "total_revenue_musd"),
    "top_directors_rating": _top_groups("director", 5, "mean_rating"),
    "top_directors_min_titles": _top_groups("director", 20, "movie_count", "count(*) >= 20"),
    "franchise_details": _filtered(
        "contains(collection_name, 'Brand#1 ')",
        ["title", "release_year", "budget_musd", "revenue_musd", "vote_average", "vote_count",
         "popularity", "director", "collection_name"]),
    "director_details": _filtered(
        "contains(lower(director), 'supplier#000000007')",
        ["title", "release_year", "budget_musd", "revenue_musd", "vote_average", "vote_count",
         "popularity", "genres", "collection_name"]),
    "genre_counts": f"""{CATALOG} SELECT genre, count(*) AS count FROM by_genre GROUP BY genre
ORDER BY count DESC, genre LIMIT 15""",
    "titles_per_year": f"""{CATALOG} SELECT release_year, count(*) AS count FROM clean
GROUP BY release_year ORDER BY release_year DESC NULLS LAST LIMIT 20""",
    "top_genres_revenue": _top_groups("genre", 10, "total_revenue_musd", source="by_genre"),
    "genre_year_trend": f"""{CATALOG} SELECT genre, release_year, {_MEASURES}
FROM by_genre WHERE release_year IS NOT NULL GROUP BY genre, release_year""",

    "overview": _overview(),
    "null_profile": _null_profile(),
    "summary_stats": _summary(),
    "exact_stats": _statistics(),
    "histogram": _histogram(),
    "correlation": _correlation(),
    "quality_report": _QUALITY,
    "chart_revenue_budget": _filtered("budget_musd > 0 AND revenue_musd > 0",
                                      ["title", "budget_musd", "revenue_musd", "release_year"]),
    "chart_trend_line": f"""{CATALOG} SELECT count(*) AS points,
  round(regr_slope(revenue_musd, budget_musd), 6) AS slope,
  round(regr_intercept(revenue_musd, budget_musd), 6) AS intercept,
  round(greatest(max(budget_musd), max(revenue_musd)), 6) AS break_even_extent
FROM clean WHERE budget_musd > 0 AND revenue_musd > 0""",
    "chart_roi_points": f"{_BOXES} SELECT genre, roi FROM points",
    "chart_roi_box": f"""{_BOXES} SELECT genre, count(*) AS points,
  round(least(min(roi) FILTER (WHERE inside), any_value(q1)) + 1e-9, 4) AS whisker_low,
  round(any_value(q1) + 1e-9, 4) AS q1, round(any_value(median) + 1e-9, 4) AS median,
  round(any_value(q3) + 1e-9, 4) AS q3,
  round(greatest(max(roi) FILTER (WHERE inside), any_value(q3)) + 1e-9, 4) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers FROM fenced GROUP BY genre""",
    "chart_roi_outliers": f"{_BOXES} SELECT genre, roi FROM fenced WHERE NOT inside",
    "chart_popularity": f"""{CATALOG} SELECT title, popularity, vote_average, vote_count,
  revenue_musd, coalesce(revenue_musd / max(revenue_musd) OVER () * 500, 50) AS bubble_size
FROM clean WHERE popularity IS NOT NULL AND vote_average IS NOT NULL AND vote_count >= 10""",
    "chart_density": f"""{CATALOG}, points AS (
  SELECT budget_musd AS x, revenue_musd AS y FROM clean
  WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL),
box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM points),
placed AS (
  SELECT CAST(least(floor((x - x0) / (x1 - x0) * 20), 19) AS INTEGER) AS cell_x,
         CAST(least(floor((y - y0) / (y1 - y0) * 20), 19) AS INTEGER) AS cell_y, x, y
  FROM points, box),
tallied AS (SELECT cell_x, cell_y, x, y, count(*) AS n FROM placed GROUP BY ALL)
SELECT cell_x, cell_y, CAST(sum(n) AS BIGINT) AS points,
  round(sum(x * n) / sum(n) + 1e-9, 4) AS mean_x, round(sum(y * n) / sum(n) + 1e-9, 4) AS mean_y,
  CASE WHEN sum(n) <= 4 THEN string_agg(CAST(CAST(x AS DECIMAL(38, 6)) AS VARCHAR) || ' ' ||
    CAST(CAST(y AS DECIMAL(38, 6)) AS VARCHAR) || ' ' || n, '; ' ORDER BY x, y) END AS exact
FROM tallied GROUP BY cell_x, cell_y""",
    "chart_yearly": _yearly("true"),
    "chart_yearly_range": _yearly("release_year BETWEEN 1997 AND 1999"),
    "chart_franchise": f"""{CATALOG} SELECT
  CASE WHEN collection_name IS NULL THEN 'Standalone' ELSE 'Franchise' END AS movie_type,
  count(*) AS count, {_BARS}, round(avg(popularity) + 1e-9, 4) AS mean_popularity,
  round(avg(roi) + 1e-9, 4) AS mean_roi FROM money GROUP BY 1""",
}


def _profile_values() -> str:
    """All parts of the profile as text, a row per cell."""
    year = "coalesce(CAST(release_year AS VARCHAR), 'null')"
    numbers = {"statistics": ["mean", "std", "min", "p25", "median", "p75", "max"],
               "summary": _NUMERIC, "null_profile": ["null_percentage"],
               "histogram": ["bin_start", "bin_end"], "correlation": _CORRELATED,
               "quality_report": ["completeness_pct", "valid_financial_pct",
                                  "reliable_rating_pct"]}
    parts = {
        "overview": ("overview", '"column"', ["ordinal", "type", "row_count", "col_count"]),
        "null_profile": ("null_profile", '"column"', ["null_count"]),
        "summary": ("summary_stats", "summary", []),
        "statistics": ("exact_stats", '"column"', ["count"]),
        "histogram": ("histogram", """"column" || '/' || bin""", ["count"]),
        "genre_counts": ("genre_counts", "genre", ["count"]),
        "titles_per_year": ("titles_per_year", year, ["count"]),
        "correlation": ("correlation", '"column"', []),
        "quality_report": ("quality_report", "''", [
            "total_rows", "total_columns", "total_cells", "filled_cells", "missing_cells",
            "valid_financial_rows", "reliable_rating_rows"]),
    }
    shown = "CAST(CAST(round({c} + 1e-9, 4) AS DECIMAL(38, 4)) AS VARCHAR)"
    cells = [f"""SELECT '{part}' AS part, {row} AS "row", '{c}' AS "column", {value} AS value
FROM ({ORACLE[name]})""" for part, (name, row, others) in parts.items()
             for c, value in [*[(c, f"CAST({c} AS VARCHAR)") for c in others],
                              *[(c, shown.format(c=c)) for c in numbers.get(part, [])]]]
    return " UNION ALL ".join(cells)


ORACLE["full_profile"] = _profile_values()
# Other ways to the same rows.
ORACLE |= {
    "clean_audit_on_write": ORACLE["clean_audit"],
    "indexed_genres_all": ORACLE["filter_genres_all"],
    "indexed_actor": ORACLE["filter_actor"],
    "frequent_genres": ORACLE["genre_counts"],
    "frequent_people": f"""{CATALOG} SELECT person, count(*) AS count
FROM (SELECT unnest(string_split("cast", '|')) AS person FROM clean) GROUP BY person
ORDER BY count DESC, person LIMIT 40""",
    "states_top_franchises": ORACLE["top_franchises_revenue"],
    "states_top_directors": ORACLE["top_directors_min_titles"],
    "states_top_genres": ORACLE["top_genres_revenue"],
    "states_genre_year_trend": ORACLE["genre_year_trend"],
}
