import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from titlelens.operators.clean import clean
from titlelens.operators.merge import merged_titles
from titlelens.plans.pipeline import run_pipeline
from titlelens.plans.scratch import scratch_path
from titlelens.sources import landing, tables
from titlelens.sources.records import RAW_SCHEMA, read_records
from titlelens.streaming.landing import clean_new_files

from conftest import column

MOVIE = {"id": 2, "title": "A \"quoted\", title", "status": "Released", "budget": 5000000,
         "revenue": 0, "release_date": "1999-03-04", "popularity": 1.5, "video": False,
         "genres": [{"id": 2, "name": "Drama"}, {"id": 1, "name": "Action"}],
         "belongs_to_collection": None, "keywords": {"keywords": []},
         "overview": "two\nlines",
         "credits": {"cast": [{"name": "Ann", "order": 0}],
                     "crew": [{"job": "Director", "name": "Bob", "department": "x"}]}}


def land(folder, *movies):
    folder.mkdir(exist_ok=True)
    for movie in movies:
        (folder / f"{movie['id']}.json").write_text(json.dumps(movie, indent=2))
    return str(folder)


def test_pretty_printed_files(spark, tmp_path):
    path = land(tmp_path / "raw", MOVIE, {**MOVIE, "id": 3, "title": "B", "budget": "12.7"})
    (tmp_path / "raw" / "notes.txt").write_text("not a record")
    rows = clean(read_records(spark, path)).orderBy("id").collect()
    first = rows[0]
    assert [r.id for r in rows] == [2, 3]
    assert (first.title, first.genres, first.keywords) == (MOVIE["title"], "Action|Drama", "")
    assert (first.budget_musd, first.revenue_musd, first.release_year) == (5.0, None, 1999)
    assert (first.cast, first.director, first.collection_name) == ("Ann", "Bob", None)
    assert rows[1].budget_musd == 12 / 1e6


def test_empty_lists_and_nulls_everywhere(spark, tmp_path):
    bare = {"id": 9, "title": "x", "status": "Released", "genres": [], "credits": None}
    row = clean(read_records(spark, land(tmp_path / "raw", bare))).first()
    assert (row.genres, row.cast, row.director, row.crew_size) == ("", None, None, None)


def test_broken_file_is_no_title(spark, tmp_path):
    path = land(tmp_path / "raw", MOVIE)
    (tmp_path / "raw" / "7.json").write_text("{ broken")
    assert column(clean(read_records(spark, path)), "id") == [2]


def test_json_lines(spark, tmp_path):
    (tmp_path / "raw.json").write_text("\n".join(json.dumps({**MOVIE, "id": i}) for i in range(5)))
    df = read_records(spark, str(tmp_path / "raw.json"), multi_line=False)
    assert clean(df).count() == 5


def test_landing_plan(spark, tmp_path):
    path = land(tmp_path / "raw", MOVIE)
    (tmp_path / "raw" / "about.json").write_text("{}")
    wanted = spark.createDataFrame([(1,), (2,), (3,), (3,)], "id long")
    landed = landing.landed_ids(spark, path)
    assert column(landed, "id") == [2]
    assert sorted(column(landing.ids_to_load(wanted, landed), "id")) == [1, 3]
    assert landing.load_count(wanted, landed).first().to_load == 2
    files = {r.file_name: r.size for r in landing.landed_files(spark, path).collect()}
    assert set(files) == {"2.json", "about.json"} and files["about.json"] == 2


def test_pipeline_saves_both_forms(spark, tmp_path):
    path = land(tmp_path / "raw", MOVIE, {**MOVIE, "id": 4, "title": "B"})
    stored = run_pipeline(spark, path, str(tmp_path / "out"), single_csv=True)
    expected = sorted(clean(read_records(spark, path)).collect())
    assert sorted(stored.collect()) == expected
    csv = tmp_path / "out" / tables.CSV_NAME
    assert len(list(csv.glob("part-*.csv"))) == 1
    back = tables.read_csv(spark, str(csv), stored.schema)
    # '' comes back as null.
    assert sorted(back.drop("keywords").collect()) == sorted(stored.drop("keywords").collect())
    assert set(column(back, "keywords")) == {None}
    # A second run overwrites.
    assert run_pipeline(spark, path, str(tmp_path / "out")).count() == 2


def test_new_files_are_merged(spark, tmp_path):
    raw, out, marks = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "marks")
    land(raw, MOVIE)

    def run():
        query = clean_new_files(spark, str(raw), out, marks)
        query.awaitTermination(120)
        assert query.exception() is None
        titles = merged_titles(spark, out, RAW_SCHEMA)
        assert sorted(titles.collect()) == sorted(clean(read_records(spark, str(raw))).collect())
        return sorted(column(titles, "id"))

    assert run() == [2]
    assert run() == [2]
    land(raw, {**MOVIE, "id": 5}, {**MOVIE, "id": 6, "status": "Rumored"})
    assert run() == [2, 5]
    # A title that is released now comes in, and of two released rows the first in order stays.
    late = land(tmp_path / "late", {**MOVIE, "id": 6}, {**MOVIE, "title": "again"})
    for i, file in enumerate(sorted(os.listdir(late))):
        shutil.copy(os.path.join(late, file), os.path.join(raw, f"late{i}.json"))
    assert run() == [2, 5, 6]


def test_scratch_path_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared + "/x-")
