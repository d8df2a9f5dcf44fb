"""Decontamination against plain Python."""

import hashlib
import random
import re

import pytest

from titlelens.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(docs, items, window=10):
    grams = []
    for item_id, text in items:
        ws = WORD.findall((text or "").translate(LOWER))
        n = min(window, len(ws))
        grams += [(tuple(ws[i:i + n]), item_id) for i in range(len(ws) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        ws = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for gram, item_id in set(grams):
            for i in range(len(ws) - len(gram) + 1):
                if tuple(ws[i:i + len(gram)]) == gram:
                    hit.update(range(i, i + len(gram)))
                    if item_id is not None:
                        found.add(item_id)
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(ws), len(hit), len(found),
                    hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def _frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "x", 1, 2) for d in docs],
                                  "doc_id long, text string, w string, pos int, n int"),
            spark.createDataFrame([(*i, "y") for i in items],
                                  "item_id long, text string, gram string"))


def _random_case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Cat", "sat", "é", "É", "42", "on", "mat"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 9, 10, 12, 20]))))
             for i in range(6)]
    items += [(None, "null id here"), (9, None), (10, ""), (11, "?!"), items[2]]
    docs = [(i, ", ".join(word() for _ in range(rng.randrange(60)))) for i in range(30)]
    docs += [(40 + i, f"some words. {rng.choice(items)[1]} and more words") for i in range(10)]
    docs += [(1, None), (2, ""), (None, items[0][1]), docs[3], docs[3], (99, "null ID here!")]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_set", [0, 20_000])
def test_equals_plain_python(spark, seed, max_set, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_SET", max_set)
    docs, items = _random_case(seed)
    frames = _frames(spark, docs, items)
    want = plain(docs, items)
    got = [tuple(r) for r in decontaminate.contamination(*frames).collect()]
    assert sorted(got, key=str) == want
    kept = decontaminate.drop_contaminated(*frames)
    assert kept.columns == frames[0].columns
    assert any(w[5] for w in want)
    clean = [d for d in docs if not plain([d], items)[0][5]]
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted(clean, key=str)


@pytest.mark.parametrize("max_set", [0, 20_000])
def test_clean_texts_stay_whatever_their_ids(spark, max_set, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_SET", max_set)
    clean = [(None, "clean one"), (1, "clean two"), (None, None), (1, ""), (2, "x"), (2, "x")]
    docs = [*clean, (None, "a bad item here"), (1, "Bad item!"), (1, "Bad item!")]
    kept = decontaminate.drop_contaminated(*_frames(spark, docs, [(1, "bad item")])).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(clean, key=str)


def test_very_long_text_and_empty_tables(spark):
    docs, items = [(1, "lorem " * 50_000 + "one two three four five six seven eight nine ten")], [
        (7, "One two three four five six seven eight nine ten")]
    frames = _frames(spark, docs, items)
    row = decontaminate.contamination(*frames).first()
    assert (row["n_words"], row["n_hit"], row["n_items"]) == (50_010, 10, 1)
    assert decontaminate.contamination(frames[0].limit(0), frames[1]).count() == 0
    bare = decontaminate.contamination(frames[0], frames[1].limit(0)).first()
    assert bare["n_hit"] == 0 and not bare["contaminated"]
    assert decontaminate.drop_contaminated(frames[0], frames[1].limit(0)).count() == 1


def test_large_benchmark_and_a_text_repeated_often(spark):
    """More windows than are looked up inside the row: hashes are joined where the rows are."""
    rng = random.Random(11)
    items = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(310))) for i in range(100)]
    docs = [(i, f"before {' '.join(items[i % 100][1].split()[5:40])} after") for i in range(20)]
    docs += [(7, "the same clean text over and over again for one id")] * 300
    docs += [(8, docs[0][1])] * 30 + [(None, docs[1][1]), (None, None)]
    frames = _frames(spark, docs, items)
    bench = decontaminate.BenchmarkWindows(frames[1])
    assert decontaminate.MAX_SET < bench.count <= decontaminate.MAX_SENT and bench.texts is None
    got = sorted(map(tuple, decontaminate.contamination(*frames).collect()), key=str)
    by_text = {}
    for doc_id, text in docs:
        if text not in by_text:
            by_text[text] = plain([(doc_id, text)], items)[0][1:]
    assert got == sorted([(doc_id, *by_text[text]) for doc_id, text in docs], key=str)
    assert decontaminate.drop_contaminated(*frames).count() == 301
