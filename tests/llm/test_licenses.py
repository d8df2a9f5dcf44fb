"""License scan: places of base phrases against plain Python, and phrases with changed words."""

import random
import re

import pytest

from titlelens.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(text):
    ws = WORD.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for label, phrase in licenses.BASE:
        p = phrase.split()
        at = [i for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels)))


def _scan(spark, texts):
    rows = [(i, t, "x", 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, pos int")
    return {r["doc_id"]: r for r in licenses.scan(docs).collect()}


def test_places_equal_plain_python(spark):
    rng = random.Random(5)
    pieces = ["GNU General Public License", "apache", "license", "CC-BY", "cc", "by", "mit",
              "MIT License", "gnu general public", "public license", "a", "É", "general"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += [None, "", "mit license mit license", "CC BY CC BY.", "x " * 30_000 + "Apache License"]
    got = _scan(spark, texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                r["base_labels"]) == plain(text), text
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= (
            set(r["labels"].split(",")) | {""})


@pytest.mark.parametrize("text,label", [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("Licensed strictly under the Apache License, Version 2.0!", "apache-2.0"),  # a word more
    ("licensed under the apache license 2 0", None),  # three of seven windows gone
    ("permission is hereby granted free of any charge to any person obtaining a copy", "mit-grant"),
    ("all rights are reserved", None), ("All Rights Reserved.", "all-rights-reserved")])
def test_own_phrases_may_differ_a_little(spark, text, label):
    found = _scan(spark, [f"some words {text} more words"])[0]["labels"].split(",")
    own = {name for name, _ in licenses.OWN}
    assert set(found) & own == ({label} if label else set())


@pytest.mark.parametrize("name", ["mit-text", "bsd-2-text", "apache-2.0-notice", "gpl-notice",
                                  "as-is"])
def test_whole_texts_are_found_over_many_diagonals(spark, name):
    """Words left out, added and changed here and there move the diagonal; three such places
    still merge into one span.  Half of a text does not make it."""
    ws = dict(licenses.OWN)[name].split()
    edited = [*ws[:9], "newly", *ws[9:20], *ws[21:]]
    edited[-4] = "another"
    halves = [" ".join(ws[:len(ws) // 2]), " ".join(ws[len(ws) // 2 + 1:])]
    shouted = "The, " + ", ".join(w.upper() for w in ws) + "!"
    got = _scan(spark, [" ".join(["intro", *ws, "end"]), " ".join(edited), shouted, *halves])
    found = [name in got[i]["labels"].split(",") for i in range(5)]
    assert found == [True, True, True, False, False]
    assert got[0]["score"] == 1.0


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "mit license")] * 3 + [(None, "mit license")],
                                 "doc_id long, text string")
    rows = licenses.scan(docs).collect()
    assert len(rows) == 4 and {r["n_base"] for r in rows} == {1}
    assert licenses.scan(docs.limit(0)).count() == 0
