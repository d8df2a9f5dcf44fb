"""Random catalogs against plain Python."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titlelens.operators import clean, rank, rollup, search

few = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

records = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.sampled_from(["A", "B"])),
    st.sampled_from(["Released", "Rumored", None])), max_size=25)


@few
@given(rows=records)
def test_kept_rows_and_audit(spark, rows):
    numbered = [(*row, i) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, "id long, title string, status string, seq int")
    survivors = {}
    for row in numbered:
        survivors.setdefault(row[0], row)
    complete = [r for r in survivors.values() if r[0] is not None and r[1] is not None]
    released = [r for r in complete if r[2] == "Released"]

    order = [F.asc("seq")]
    kept = clean.keep_released(df, order).collect()
    assert sorted((r.id, r.title, r.seq) for r in kept) == sorted(
        (r[0], r[1], r[3]) for r in released)
    audit = clean.removal_audit(df, order).first().asDict()
    assert audit == {"rows_before": len(rows), "duplicates_removed": len(rows) - len(survivors),
                     "incomplete_removed": len(survivors) - len(complete),
                     "unreleased_removed": len(complete) - len(released),
                     "rows_after": len(released), "rows_removed": len(rows) - len(released)}


@pytest.fixture(scope="module")
def catalog(spark):
    rng = random.Random(4)
    names, genres = ["ann lee", "Bo", "Cy Ann", "dee"], ["Action", "Live Action", "Drama", ""]
    rows = []
    for i in range(400):
        # A third of all titles share one director, one collection and one genre.
        hot = i % 3 == 0
        rows.append({
            "id": i, "title": f"t{i}", "genres": "Drama" if hot else rng.choice(
                [None, "|".join(rng.sample(genres, rng.randint(1, 3)))]),
            "cast": rng.choice([None, "|".join(rng.sample(names, 2))]),
            "director": "Hot" if hot else rng.choice([None, *names]),
            "collection_name": "Saga" if hot else rng.choice([None, "Other"]),
            "budget_musd": rng.choice([None, 0.0, float(rng.randint(1, 60))]),
            "revenue_musd": rng.choice([None, float(rng.randint(0, 300))]),
            "vote_average": rng.choice([None, float(rng.randint(0, 10))]),
            "vote_count": rng.choice([None, rng.randint(0, 40)]),
            "popularity": rng.choice([None, float(rng.randint(0, 9))]),
            "release_year": rng.choice([None, rng.randint(1990, 1999)])})
    schema = ("id long, title string, genres string, cast string, director string, "
              "collection_name string, budget_musd double, revenue_musd double, "
              "vote_average double, vote_count long, popularity double, release_year int")
    ordered = [tuple(r.values()) for r in rows]
    return spark.createDataFrame(ordered, schema).repartition(5).cache(), rows


@few
@given(genres=st.one_of(st.none(), st.lists(st.sampled_from(["Action", "Drama", "Live"]),
                                            max_size=2)),
       actors=st.one_of(st.none(), st.sampled_from(["ANN", "bo"]).map(lambda a: [a, "zed"])),
       rating=st.one_of(st.none(), st.integers(0, 9)), votes=st.one_of(st.none(), st.just(10)),
       sort_by=st.sampled_from(["vote_average", "revenue_musd"]), ascending=st.booleans(),
       n=st.one_of(st.none(), st.integers(1, 30)))
def test_search(catalog, genres, actors, rating, votes, sort_by, ascending, n):
    df, rows = catalog
    found = [r for r in rows
             if (genres is None or all(r["genres"] is not None and g in r["genres"] for g in genres))
             and (actors is None or any(a.lower() in (r["cast"] or "").lower() for a in actors))
             and (rating is None or (r["vote_average"] is not None and r["vote_average"] >= rating))
             and (votes is None or (r["vote_count"] is not None and r["vote_count"] >= votes))]
    null_first = -math.inf
    found.sort(key=lambda r: (
        (r[sort_by] if r[sort_by] is not None else null_first) * (1 if ascending else -1), r["id"]))
    got = search.search(df, genres, actors, min_rating=rating, min_votes=votes, sort_by=sort_by,
                        ascending=ascending, n=n)
    assert [r.id for r in got.collect()] == [r["id"] for r in found[:n]]


@pytest.mark.parametrize("name", rank.RANKINGS)
def test_rankings(catalog, name):
    df, rows = catalog
    metric, ascending, _ = rank.RANKINGS[name]
    scored = []
    for r in rows:
        budget, revenue = r["budget_musd"], r["revenue_musd"]
        both = budget is not None and revenue is not None
        values = {**r, "profit_musd": revenue - budget if both else None,
                  "roi": (revenue - budget) / budget * 100 if both and budget > 0 else None}
        if name.endswith("roi") and (budget is None or budget < 10):
            continue
        if name.endswith("rated") and (r["vote_count"] is None or r["vote_count"] < 10):
            continue
        if values[metric] is not None:
            scored.append((values[metric] * (1 if ascending else -1), r["id"], r["title"]))
    expected = [(i, title) for i, (_, _, title) in enumerate(sorted(scored)[:15], 1)]
    assert [(r.rank, r.title) for r in rank.ranking(df, name, 15).collect()] == expected


@pytest.mark.parametrize("key", ["director", "collection_name"])
def test_groups_with_a_hot_key(catalog, key):
    df, rows = catalog
    groups = {}
    for r in rows:
        if r[key] is not None:
            groups.setdefault(r[key], []).append(r)

    def mean(members, name):
        known = [m[name] for m in members if m[name] is not None]
        return sum(known) / len(known) if known else None

    got = {g[key]: g for g in rollup.top_groups(df, key, n=100).collect()}
    assert set(got) == set(groups)
    for name, members in groups.items():
        assert got[name].movie_count == len(members)
        assert got[name].mean_rating == pytest.approx(mean(members, "vote_average"))
        assert got[name].mean_revenue_musd == pytest.approx(mean(members, "revenue_musd"))
        assert got[name].total_budget_musd == sum(m["budget_musd"] or 0 for m in members)
