"""The substring index, merged landings, whole ranks, rollup states and frequent tokens."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from titlelens.operators import chartdata, clean, frequent, merge, rank, rollup, search, states
from titlelens.operators import substring_index as index_module
from titlelens.operators.substring_index import build_index, candidates, filter_indexed, search_indexed
from titlelens.plans.scratch import scratch_path, stored
from titlelens.sources import tables
from titlelens.sources.records import read_with_quarantine

from conftest import column


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- substring index ---------------------------------------------------------------------------

WORDS = ["Anna", "ANNE", "Hannah", "Émile", "emile zola", "Ζωή", "a|b", "x", "", "straße", "🙂🙂🙂 ok",
         "ΟΔΟΣ", "aaaa"]


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "|".join(rng.sample(WORDS, rng.randrange(4)))]),
             rng.choice([None, *WORDS]), rng.choice([None, *WORDS])) for i in range(300)]
    return stored(spark.createDataFrame(
        rows, "id long, genres string, cast string, director string").repartition(3), "people")


@pytest.fixture(scope="module")
def index(spark, people):
    return build_index(people, scratch_path(spark, "index"),
                       {"genres": False, "cast": True, "director": True})


@pytest.mark.parametrize("words", [
    "ann", "ANN", "anna", "É", "mile", "ile zo", "", "a|b", "straße", "STRASSE", "🙂", "ωή", "οδος",
    "aaaa", "nowhere at all", ["ann", "zola"], ["ann", "x"], ["hannah", "anna"], []])
@pytest.mark.parametrize("every", [True, False])
def test_index_finds_what_the_filter_finds(people, index, words, every):
    for name, fold in index.columns.items():
        wanted = people.filter(index_module.matches(name, words, every=every, ignore_case=fold))
        found = filter_indexed(people, index, name, words, every)
        assert sorted(column(found, "id")) == sorted(column(wanted, "id"))


def test_indexed_search_is_the_search(people, index):
    asked = {"genres": ["ann"], "actors": ["anna", "zola"], "directors": ["an", "mile"]}
    wanted = search.search(people, **asked)
    assert sorted(column(search_indexed(people, index, **asked), "id")) == sorted(
        column(wanted, "id"))


def test_trigrams_are_cut_without_a_lambda(spark):
    texts = [None, "", "ab", "abc", "aaaaa", "🙂🙂🙂 ok", "a\nb\r\u2028c", *WORDS]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", index_module.grams(F.col("t")).alias("grams"))
    for row in df.collect():
        t = row.t or ""
        assert sorted(row.grams) == sorted({t[i:i + 3] for i in range(len(t) - 2)})
    assert "lambda" not in _plan(df)  # it is not compiled


def test_postings_are_pruned(people, index):
    plan = _plan(filter_indexed(people, index, "cast", "hannah"))
    (scan,) = [line for line in plan.splitlines() if "postings" in line]
    assert "PartitionFilters: [isnotnull(text_of" in scan and "folder" in scan.split(
        "PartitionFilters")[1].split("PushedFilters")[0]
    assert "In(gram" in scan or "EqualTo(gram" in scan
    assert candidates(index, "cast", "hannah").count() < people.count()
    assert candidates(index, "cast", "no such name").count() == 0
    assert candidates(index, "cast", "no") is None


# --- merged landings ---------------------------------------------------------------------------

RAW = ("id string, title string, status string, budget string, genres array<struct<name:string>>, "
       "belongs_to_collection struct<name:string>, tagline string, release_date string")


def _records(n=60, seed=0):
    rng = random.Random(seed)
    return [(rng.choice([None, *map(str, range(25)), "x"]), rng.choice([None, "A", "B", "nan"]),
             rng.choice([None, "Released", "Rumored"]), rng.choice(["0", "12.0", "bad", "7"]),
             rng.choice([None, [], [("b",), ("a",)]]), rng.choice([None, ("S",)]),
             rng.choice(["", "n/a", "t"]), rng.choice(["", "2001-02-03"])) for _ in range(n)]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_landings_in_any_order_are_one_clean(spark, order, tmp_path):
    raw = spark.createDataFrame(_records(), RAW)
    wanted = sorted(map(str, clean.clean(raw).collect()))
    parts = [spark.createDataFrame(_records()[i::3], RAW) for i in range(3)]
    path = str(tmp_path / "table")
    for i in (*order, order[0]):
        merge.merge_landing(parts[i], path, 8)
    got = merge.merged_titles(spark, path, raw.schema)
    assert got.columns == clean.clean(raw).columns
    assert sorted(map(str, got.collect())) == wanted
    for wanted_id in (3, 4, 99):
        one = merge.find_title(spark, path, raw.schema, wanted_id)
        assert one.collect() == got.filter(F.col("id") == wanted_id).collect()


def test_a_landing_touches_its_buckets_only(spark, tmp_path):
    raw = spark.createDataFrame(_records(200), RAW)
    path = str(tmp_path / "table")
    assert merge.merge_landing(raw.limit(0), path, 8) == 0
    assert merge.merged_titles(spark, path, raw.schema).count() == 0
    assert merge.merge_landing(raw, path, 8) > 5
    before, buckets, landings = merge.manifest(spark, path)
    assert (buckets, landings) == (8, 1)
    assert merge.merge_landing(raw.filter("id = '3'"), path, 8) == 1
    after, _, _ = merge.manifest(spark, path)
    assert sum(after[b] != before[b] for b in before) == 1
    with pytest.raises(ValueError):
        merge.merge_landing(raw, path, 4)
    # Files that no manifest names, as a failed landing leaves them, are not read.
    n = merge.merged_titles(spark, path, raw.schema).count()
    merge.survivors(raw).withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(
        f"{path}/versions/lost/merged")
    assert merge.merged_titles(spark, path, raw.schema).count() == n


# --- rank of all rows --------------------------------------------------------------------------

def test_rank_all_equals_sorting(spark):
    rng = random.Random(4)
    rows = [(i, f"t{i}", rng.choice([None, float("nan"), 1.0, 1.0, 1.0, rng.random()]))
            for i in range(500)]
    df = spark.createDataFrame(rows, "id long, title string, score double").repartition(7)
    got = rank.rank_all(df, "score")
    order = [F.desc("score"), F.asc("id")]
    wanted = [r.id for r in df.filter("score is not null").orderBy(*order).collect()]
    assert [r.id for r in sorted(got.collect(), key=lambda r: r["rank"])] == wanted
    assert sorted(column(got, "rank")) == list(range(1, len(wanted) + 1))
    assert "SinglePartition" not in _plan(got) and "Window" not in _plan(got)
    assert rank.rank_all(df.limit(0), "score").count() == 0
    some = rank.rank_all(df, "score", ascending=True, where=F.col("id") < 50, tie=["title"])
    assert some.orderBy("rank").first().score == min(s for i, _, s in rows[:50] if s is not None)


# --- rollup states -----------------------------------------------------------------------------

def _titles(spark):
    rng = random.Random(7)
    return spark.createDataFrame(
        [(i, rng.choice([None, "S1", "S2"]), rng.choice([None, "D1", "D2", "D3"]),
          rng.choice([None, "", "a|b", "b", "c|a"]), rng.choice([None, 1999, 2000]),
          rng.choice([None, 1.5, 2.25]), rng.choice([None, 10.5, 3.0]), rng.choice([None, 5.5, 7.0]),
          rng.choice([None, 3, 9])) for i in range(80)],
        "id long, collection_name string, director string, genres string, release_year int, "
        "budget_musd double, revenue_musd double, vote_average double, vote_count long")


def test_states_are_the_rollups(spark, tmp_path):
    titles, path = _titles(spark), str(tmp_path / "states")
    for i in range(4):
        states.add_titles(titles.filter(F.col("id") % 4 == i), path)
    wrong = titles.withColumn("director", F.lit("D9")).limit(9)
    states.add_titles(wrong, path)
    states.add_titles(wrong, path, sign=-1)
    states.compact(spark, path, f"{path}2")
    for where in (path, f"{path}2"):
        held = states.read_states(spark, where)
        for name, rolled in (("collection_name", rollup.top_franchises(titles)),
                             ("director", rollup.top_directors(titles, 2, "mean_rating")),
                             ("genre", rollup.top_genres_by_revenue(titles))):
            n, by = (2, "mean_rating") if name == "director" else (10, "total_revenue_musd")
            got = states.top_groups(held, name, n, by)
            assert got.columns == rolled.columns and got.collect() == rolled.collect()
        assert states.genre_year_trend(held).collect() == rollup.genre_year_trend(titles).collect()
    plan = _plan(states.top_groups(states.read_states(spark, path), "director"))
    assert "dimension" in plan.split("PartitionFilters")[1][:80]


# --- frequent tokens ---------------------------------------------------------------------------

@pytest.mark.parametrize("candidates", [2, 5, 1000])
def test_frequent_tokens_are_exact(spark, candidates, monkeypatch):
    rng = random.Random(1)
    tokens = [f"t{min(int(rng.paretovariate(0.7)), 3000)}" for _ in range(6000)]
    df = spark.createDataFrame([("|".join(tokens[i:i + 3]),) for i in range(0, 6000, 3)]
                               + [(None,), ("",)], "genres string").repartition(4)
    full = []
    true = rollup.token_counts
    monkeypatch.setattr(frequent, "token_counts", lambda *a: full.append(1) or true(*a))
    for n in (1, 5, 40):
        assert frequent.frequent_tokens(df, n=n, candidates=candidates).collect() == true(
            df, n=n).collect()
    assert full or candidates == 1000  # a few candidates cannot tell the first forty
    assert frequent.frequent_tokens(df.limit(0)).collect() == []


def test_a_clear_winner_needs_no_full_count(spark, monkeypatch):
    monkeypatch.setattr(frequent, "token_counts", None)
    df = spark.createDataFrame([("a|b",)] * 50 + [("b|c",)] * 30 + [("d",)], "genres string")
    assert [tuple(r) for r in frequent.frequent_tokens(df, n=3).collect()] == [
        ("b", 80), ("a", 50), ("c", 30)]


# --- landing quality, layout, density ----------------------------------------------------------

def test_quarantine(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1, "title": "A"}\n{"id": 2, "title": \n'
                                   '{"title": "no key"}\n{"id": "x9"}\nnot json at all\n')
    (folder / "b.json").write_text('{"id": 5, "genres": [{"name": "g"}]}\n{"id": 6, "genres": 7}\n')
    (folder / "note.txt").write_text("{")
    good, aside = read_with_quarantine(spark, str(folder), str(tmp_path / "aside"))
    assert sorted(column(good, "id")) == ["1", "5"]
    told = sorted((r.file_name, r.reason, r.record) for r in aside.collect())
    assert [t[:2] for t in told] == [
        ("a.json", "key is no number"), ("a.json", "no key"), ("a.json", "unreadable"),
        ("a.json", "unreadable"), ("b.json", "unreadable")]
    assert "not json at all" in {t[2] for t in told} and all(t[2] for t in told)


def test_audit_of_the_write_is_the_audit(spark, tmp_path):
    raw = spark.createDataFrame(_records(120, 3), RAW)
    table, audit = clean.clean_and_audit(raw, str(tmp_path / "clean"))
    assert audit == clean.removal_audit(clean.fix_types(raw)).first().asDict()
    assert sorted(map(str, table.collect())) == sorted(map(str, clean.clean(raw).collect()))


def test_clustered_files_are_skipped(spark, tmp_path):
    df = spark.range(40_000).selectExpr("id", "cast(id * 7919 % 50 + 1970 as int) release_year",
                                        "id % 11 / 1.0D vote_average")
    tables.write_clustered(df, str(tmp_path / "t"), files=16)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(back.collect()) == sorted(df.collect())
    held = back.filter("release_year = 1983").select("_metadata.file_name").distinct().count()
    assert 1 <= held <= 2 < back.select("_metadata.file_name").distinct().count()


def test_density_counts_every_point(spark):
    rng = random.Random(0)
    rows = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(2000)] + [(9.0, 9.0), (9.0, 9.0)]
    odd = [(None, 1.0), (float("nan"), 1.0), (float("inf"), 2.0)]
    df = spark.createDataFrame(rows + odd, "a double, b double")
    got = chartdata.density_grid(df, "a", "b", 10, 2).collect()
    assert sum(r.points for r in got) == len(rows)
    assert [(r.cell_x, r.cell_y) for r in got] == sorted((r.cell_x, r.cell_y) for r in got)
    assert got[-1].exact == "9.000000 9.000000 2" and got[-1].points == 2
    assert all((r.exact is not None) == (r.points <= 2) for r in got)
    flat = chartdata.density_grid(spark.createDataFrame([(1.0, 2.0)] * 3, "a double, b double"),
                                  "a", "b", 10, 5).collect()
    assert [(r.cell_x, r.cell_y, r.points) for r in flat] == [(0, 0, 3)]
    assert chartdata.density_grid(df.limit(0), "a", "b").count() == 0
