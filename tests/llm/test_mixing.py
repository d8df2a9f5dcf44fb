"""Mixing: water-filling by hand, seeded repetitions, odd rows."""

import pytest

from titlelens.llm import mixing

DDL = "doc_id long, text string, source string, size string, whole int, cut string, key int"


def _docs(spark, rows):
    """Rows (doc_id, words, source), with further columns named like the operator's own."""
    return spark.createDataFrame(
        [(i, None if n is None else " ".join(["x"] * n), s, "big", 7, "deep", 1)
         for i, n, s in rows], DDL)


def plain_targets(sizes, weights=(5, 2, 1), epochs=3):
    """Clamp and share again until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in clamped)
        share = sum(weight[s] for s in order if s not in clamped)
        goal = {s: epochs * sizes[s] if s in clamped else left * weight[s] / share for s in order}
        above = {s for s in order if s not in clamped and goal[s] > epochs * sizes[s]}
        if not above:
            return goal
        clamped |= above


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 100, "c": 50}, {"a": 1, "b": 2, "c": 3, None: 400},
    {"b": 5, "é": 5, "z": 5, "Z": 90}, {"only": 7}])
def test_targets_equal_plain_water_filling(spark, sizes):
    docs = _docs(spark, [(i, n, s) for i, (s, n) in enumerate(sizes.items())])
    got = {r["source"]: r["target"] for r in mixing.targets(mixing.sizes(docs)).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_taken_is_near_the_target_and_reruns_agree(spark):
    rows = [(i, 1 + i * 7 % 13, "abcdefgh"[i % 5 if i % 3 else 0]) for i in range(400)]
    docs = _docs(spark, rows)
    report = mixing.mix_report(docs).collect()
    assert len(report) == 400
    goal, taken = {}, {}
    source = {i: s for i, _, s in rows}
    for r in report:
        goal[source[r["doc_id"]]] = r["target"]
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
    assert all(abs(taken[s] - goal[s]) <= 7 for s in goal)
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, report))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert copies == {r["doc_id"]: r["copies"] for r in report if r["copies"]}


def test_odd_rows(spark):
    docs = _docs(spark, [(1, None, "a"), (2, 0, "a"), (None, 4, None), (3, 4, None), (3, 4, None),
                         (4, 3000, "b")])
    report = mixing.mix_report(docs).collect()
    assert len(report) == 6
    by_id = {r["doc_id"]: r for r in report}
    assert by_id[1]["size"] == by_id[2]["size"] == 0 and by_id[1]["target"] == 0
    assert by_id[4]["source_size"] == 3000
    assert len({(r["taken"], r["copies"]) for r in report if r["doc_id"] == 3}) == 1
    assert mixing.mix_report(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_no_document_goes_beyond_the_cap(spark):
    """A capped source takes its wordless documents as often as the others."""
    rows = [(i, "one two three", "a") for i in range(6)] + [(10 + i, "", "a") for i in range(40)]
    rows += [(100 + i, "word " * 200, "b") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_report(docs).collect()
    assert {r["copies"] for r in got if r["doc_id"] < 100} == {mixing.MAX_EPOCHS}
    clashing = docs.selectExpr("*", "1 copy", "2 row", "3 plan_source", "4 cut")
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns
    assert mixed.count() == sum(r["copies"] for r in got)
