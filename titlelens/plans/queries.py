"""The query registry: every operator over the whole catalog of the given tables.

Values of single titles are compared as they are.  Sums and means of doubles depend on the order
of the rows in their last digits, so both sides of the SQL check round those.  Money has 6
places, and so have its totals; a mean that lies halfway is nudged up on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelens.functions import metrics
from titlelens.operators import (chartdata, clean, frequent, merge, profile, rank, rollup, search,
                                 states, substring_index)
from titlelens.plans import catalog
from titlelens.plans.scratch import scratch_path, stored
from titlelens.sources import landing, records, tables

Query = Callable[[SparkSession, str], DataFrame]

TOTALS = {"total_budget_musd", "total_revenue_musd", "total_revenue"}
LISTED = ["id", "title", "genres", "cast", "director", "release_year", "vote_average"]


raw_titles = catalog.raw_titles
clean_titles = catalog.clean_titles


def rounded(df: DataFrame, places: int) -> DataFrame:
    """Round the doubles.  Of four places, a value halfway is nudged up on both sides first."""
    nudge = 1e-9 if places == 4 else 0.0
    return df.withColumns({
        f.name: F.round(f.name, 6) if f.name in TOTALS else F.round(F.col(f.name) + nudge, places)
        for f in df.schema if f.dataType.typeName() == "double"
    })


def _on_clean(operator: Callable[[DataFrame], DataFrame], places: int | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = operator(clean_titles(spark, sf_dir))
        return result if places is None else rounded(result, places)
    return query


def _on_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(raw_titles(spark, sf_dir))


def _flat(raw: DataFrame) -> DataFrame:
    return clean.flatten_names(clean.drop_unused(raw))


def _landed_released(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Land the released records as JSON lines; the folder and the ids read back from it."""
    path = scratch_path(spark, "landed")
    raw_titles(spark, sf_dir).filter("status = 'Released'").select("id", "title").write.json(path)
    landed = records.read_records(spark, path, multi_line=False)
    return path, landed.select(F.col("id").try_cast("bigint").alias("id"))


def _landing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, landed = _landed_released(spark, sf_dir)
    wanted = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"))
    return landing.ids_to_load(wanted, landed)


def _load_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, landed = _landed_released(spark, sf_dir)
    wanted = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"))
    return landing.load_count(wanted, landed)


def _landed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names and sizes differ from run to run; what they add up to does not."""
    path, _ = _landed_released(spark, sf_dir)
    held = (records.read_records(spark, path, multi_line=False)
            .groupBy(F.col("_metadata.file_name").alias("file_name"))
            .agg(F.count("*").alias("records")))
    return landing.landed_files(spark, path).join(held, "file_name", "left").agg(
        F.sum("records").alias("landed_records"),
        F.count_if(F.col("records").isNotNull() & (F.col("size") <= 0)).alias("empty_files"))


def _roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    raw_titles(spark, sf_dir).write.json(path)
    return clean.clean(records.read_records(spark, path, multi_line=False))


def _roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clean")
    titles = clean_titles(spark, sf_dir)
    tables.write_parquet(titles, path)
    return spark.read.schema(titles.schema).parquet(path)


def _roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clean-csv")
    titles = clean_titles(spark, sf_dir)
    tables.write_csv(titles, path)
    return tables.read_csv(spark, path, titles.schema)


def _roundtrip_one_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalog in one file."""
    path = scratch_path(spark, "one-csv")
    titles = clean_titles(spark, sf_dir)
    tables.write_csv(titles, path, single_file=True)
    return tables.read_csv(spark, path, titles.schema)


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every record as a line, some cut short, some with a key that is no number."""
    path = scratch_path(spark, "dirty")
    records_of = raw_titles(spark, sf_dir).select(
        "id", F.when(F.col("id") % 19 == 0, F.concat(F.lit("x"), "id")).otherwise(
            F.col("id").cast("string")).alias("shown"), "title", "status")
    line = F.to_json(F.struct(F.col("shown").alias("id"), "title", "status"))
    (records_of.select(F.when(F.col("id") % 17 == 0, F.substring(line, F.lit(1), F.length(line) - 3))
                       .otherwise(line).alias("value"))
     .select(F.col("value")).write.option("compression", "none").text(f"{path}/lines"))
    good, aside = records.read_with_quarantine(spark, f"{path}/lines", f"{path}/aside",
                                               pattern="*.txt")
    return (aside.groupBy("reason").agg(F.count("*").alias("records"),
                                        F.count("file_name").alias("with_file"),
                                        F.count("record").alias("with_text"))
            .union(good.agg(F.lit("good"), F.count("*"), F.lit(0).cast("long"),
                            F.count("title"))))


def _scan_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pretty-printed file for each director, scanned once and looked at twice."""
    path = scratch_path(spark, "pretty")
    people = spark.read.parquet(f"{sf_dir}/supplier.parquet").filter("s_suppkey % 7 = 0")
    (people.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"),
                   F.lit("Released").alias("status"),
                   F.array(F.struct(F.col("s_name").alias("name"))).alias("genres"),
                   F.col("s_suppkey").alias("file"))
     .write.option("pretty", True).partitionBy("file").json(path))
    scanned = records.scan_cached(spark, f"{path}/*")
    counts = scanned.groupBy("status").agg(F.count("*").alias("records"))
    # One row is broadcast.
    return scanned.join(F.broadcast(counts), "status").select(
        F.col("id").try_cast("bigint").alias("id"), "title", F.col("genres")[0]["name"].alias(
            "genre"), "records")


def _audit_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_titles(spark, sf_dir)
    _, audit = clean.clean_and_audit(raw, scratch_path(spark, "audited"),
                                     clean.row_order(raw, whole=False))
    return spark.createDataFrame([tuple(audit.values())],
                                 ", ".join(f"{name} long" for name in audit))


def _merged_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in three landings, copies apart from what they copy, the last landing twice."""
    raw, path = stored(raw_titles(spark, sf_dir), "raw"), scratch_path(spark, "merged")
    part = F.pmod(F.xxhash64("id", "title", "status"), F.lit(3))
    for i in (2, 0, 1, 1):
        merge.merge_landing(raw.filter(part == i), path, 16)
    return merge.merged_titles(spark, path, raw.schema)


def _clustered_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, titles = scratch_path(spark, "clustered"), clean_titles(spark, sf_dir)
    tables.write_clustered(titles, path)
    clustered = spark.read.schema(titles.schema).parquet(path)
    return search.filter_years(clustered, 1996, 1998).select(*LISTED)


def _indexed(answer: Callable[[DataFrame, substring_index.SubstringIndex], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        titles = stored(clean_titles(spark, sf_dir), "titles")
        index = substring_index.build_index(
            titles, scratch_path(spark, "grams"), {"genres": False, "cast": True, "director": True})
        return answer(titles, index)
    return query


def _by_states(answer: Callable[[DataFrame], DataFrame]) -> Query:
    """Three landings; one is landed by mistake and taken out again."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, titles = scratch_path(spark, "states"), stored(clean_titles(spark, sf_dir), "titles")
        landings = [titles.filter(F.col("id") % 3 == i) for i in range(3)]
        states.add_titles(landings[1], path)
        states.add_titles(landings[1], path, sign=-1)
        return rounded(states.after_landings(landings, path, answer), 4)
    return query


def _landed_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the suppliers, those not landed yet, where each director's record is a folder of its
    id: told by names, without opening a file."""
    path = scratch_path(spark, "people")
    people = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    (people.filter("s_suppkey % 7 = 0")
     .select("s_name", F.concat(F.col("s_suppkey").cast("string"), F.lit(".json")).alias("file"))
     .write.partitionBy("file").json(path))
    wanted = people.select(F.col("s_suppkey").alias("id"))
    return landing.ids_to_load(wanted, landing.landed_ids(spark, path))


def _summary_as_numbers(df: DataFrame) -> DataFrame:
    text = profile.summary(df)
    return text.select("summary", *[F.col(c).try_cast("double").alias(c)
                                    for c in text.columns if c != "summary"])


QUERIES: dict[str, Query] = {
    # cleaning
    "clean_catalog": _on_clean(lambda df: df),
    "clean_audit": _on_raw(lambda raw: clean.removal_audit(_flat(raw))),
    "flatten_names": _on_raw(
        lambda raw: _flat(raw).select(
            "id", "genres", "collection_name", "production_companies", "production_countries",
            "spoken_languages", "keywords")),
    "fix_types": _on_raw(
        lambda raw: clean.fix_types(_flat(raw)).select(
            "id", "release_date", "budget", "revenue", "runtime", "budget_musd", "revenue_musd",
            "overview", "tagline")),
    "dedupe_ids": _on_raw(
        lambda raw: clean.dedupe(raw.select("id", "title", "status"))),
    "people_features": _on_raw(
        lambda raw: clean.add_features(clean.fix_types(raw)).select(
            "id", "cast", "cast_size", "director", "crew_size", "release_year", "tagline", "title")),
    "sort_tokens": _on_raw(lambda raw: clean.sort_tokens(_flat(raw)).select("id", "genres")),
    # sources and sinks
    "landing_plan": _landing_plan,
    "load_count": _load_count,
    "landed_inventory": _landed_inventory,
    "landed_by_name": _landed_by_name,
    "scan_cached": _scan_cached,
    "quarantine": _quarantine,
    "clean_audit_on_write": _audit_on_write,
    "merged_landings": _merged_landings,
    "clustered_years": _clustered_years,
    "roundtrip_json": _roundtrip_json,
    "roundtrip_parquet": _roundtrip_parquet,
    "roundtrip_csv": _roundtrip_csv,
    "roundtrip_one_csv": _roundtrip_one_csv,
    # rankings
    **{f"rank_{name}": _on_clean(lambda df, name=name: rank.ranking(df, name))
       for name in rank.RANKINGS},
    "rank_top_roi_big_budget": _on_clean(
        lambda df: rank.rank_by(df, "roi", where=F.col("budget_musd") >= 100, n=25)),
    "rank_bottom_rated_many_votes": _on_clean(
        lambda df: rank.rank_by(df, "vote_average", ascending=True,
                                where=F.col("vote_count") >= 30)),
    "rank_all_roi": _on_clean(
        lambda df: rank.rank_all(df, "roi").select("rank", "id", "title", "roi")),
    "rank_all_rating": _on_clean(
        lambda df: rank.rank_all(df, "vote_average", ascending=True).select(
            "rank", "id", "vote_average")),
    "best_value": _on_clean(rank.best_value),
    "top_standalone_revenue": _on_clean(rank.top_standalone_revenue),
    # filters and search
    "filter_genres_all": _on_clean(
        lambda df: search.filter_genres(df, ["ring", "small"]).select(*LISTED)),
    "filter_genres_any": _on_clean(
        lambda df: search.filter_genres(df, ["gear", "PROMO"], match_all=False).select(*LISTED)),
    "filter_genres_exact": _on_clean(
        lambda df: search.filter_genres(df, "old", exact=True).select(*LISTED)),
    "filter_actor": _on_clean(
        lambda df: search.filter_actor(df, "SUPPLIER#00000001").select(*LISTED)),
    "filter_director": _on_clean(
        lambda df: search.filter_director(df, "Supplier#00000000",
                                          case_sensitive=True).select(*LISTED)),
    "filter_years": _on_clean(lambda df: search.filter_years(df, 1996, 1998).select(*LISTED)),
    "filter_valid_financials": _on_clean(
        lambda df: df.filter(metrics.valid_financials()).select("id", "budget_musd", "revenue_musd")),
    "filter_reliable_rating": _on_clean(
        lambda df: df.filter(metrics.reliable_rating(30)).select("id", "vote_count",
                                                                "vote_average")),
    "search_multi": _on_clean(
        lambda df: search.search(df, genres="small", actors=["supplier#000000001",
                                                             "supplier#000000002"],
                                 min_rating=4.5, min_votes=20, n=20)
        .select("id", "title", "vote_average", "genres", "cast", "vote_count")),
    "search_directors": _on_clean(
        lambda df: search.search(df, directors=["supplier#000000007", "SUPPLIER#000000014"],
                                 sort_by="revenue_musd", n=20)
        .select("id", "title", "revenue_musd", "director")),
    "search_preset_rating": _on_clean(
        lambda df: search.best_rated_with(df, ["ring", "LARGE"], "Supplier#00000000")),
    "search_preset_runtime": _on_clean(
        lambda df: search.shortest_by_pair(df, "supplier#00000000", "supplier#00000000")),
    "indexed_genres_all": _indexed(
        lambda df, index: substring_index.filter_indexed(df, index, "genres", ["ring", "small"])
        .select(*LISTED)),
    "indexed_actor": _indexed(
        lambda df, index: substring_index.filter_indexed(df, index, "cast", "SUPPLIER#00000001")
        .select(*LISTED)),
    "indexed_search": _indexed(
        lambda df, index: substring_index.search_indexed(
            df, index, genres="mall", actors=["supplier#000000001", "supplier#000000002", "#0"],
            directors=["supplier#000000007", "SUPPLIER#00000001"]).select(*LISTED)),
    # rollups
    "row_count": _on_clean(rollup.row_count),
    "compare_franchise": _on_clean(rollup.compare_franchises, 4),
    "top_franchises_revenue": _on_clean(rollup.top_franchises, 4),
    "top_franchises_rating": _on_clean(lambda df: rollup.top_franchises(df, 5, "mean_rating"), 4),
    "top_directors_revenue": _on_clean(rollup.top_directors, 4),
    "top_directors_rating": _on_clean(lambda df: rollup.top_directors(df, 5, "mean_rating"), 4),
    "top_directors_min_titles": _on_clean(
        lambda df: rollup.top_directors(df, 20, "movie_count", min_titles=20), 4),
    "franchise_details": _on_clean(lambda df: rollup.franchise_details(df, "Brand#1 ")),
    "director_details": _on_clean(lambda df: rollup.director_details(df, "SUPPLIER#000000007")),
    "genre_counts": _on_clean(rollup.token_counts),
    "titles_per_year": _on_clean(rollup.titles_per_year),
    "top_genres_revenue": _on_clean(rollup.top_genres_by_revenue, 4),
    "genre_year_trend": _on_clean(rollup.genre_year_trend, 4),
    "frequent_genres": _on_clean(frequent.frequent_tokens),
    "frequent_people": _on_clean(
        lambda df: frequent.frequent_tokens(df, "cast", "person", 40)),
    "states_top_franchises": _by_states(lambda df: states.top_groups(df, "collection_name")),
    "states_top_directors": _by_states(
        lambda df: states.top_groups(df, "director", 20, "movie_count", 20)),
    "states_top_genres": _by_states(lambda df: states.top_groups(df, "genre")),
    "states_genre_year_trend": _by_states(states.genre_year_trend),
    # profiling
    "overview": _on_clean(profile.overview),
    "null_profile": _on_clean(profile.null_profile),
    "summary_stats": _on_clean(_summary_as_numbers, 6),
    "exact_stats": _on_clean(profile.statistics, 8),
    "histogram": _on_clean(profile.histogram),
    "correlation": _on_clean(profile.correlation_matrix, 6),
    "quality_report": _on_clean(profile.quality_report, 4),
    "full_profile": _on_clean(
        lambda df: profile.profile_values(profile.full_profile(df, all_parts=True))),
    # chart data
    "chart_revenue_budget": _on_clean(chartdata.budget_revenue_points),
    "chart_trend_line": _on_clean(chartdata.budget_revenue_line, 6),
    "chart_roi_points": _on_clean(chartdata.roi_by_genre),
    "chart_roi_box": _on_clean(chartdata.roi_boxes, 4),
    "chart_roi_outliers": _on_clean(chartdata.roi_outliers),
    "chart_popularity": _on_clean(chartdata.popularity_rating_points),
    "chart_density": _on_clean(
        lambda df: chartdata.density_grid(df, "budget_musd", "revenue_musd", 20, 4), 4),
    "chart_yearly": _on_clean(chartdata.yearly_box_office, 4),
    "chart_yearly_range": _on_clean(lambda df: chartdata.yearly_box_office(df, 1997, 1999), 4),
    "chart_franchise": _on_clean(chartdata.franchise_bars, 4),
}
