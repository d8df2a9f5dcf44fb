"""Spelling variants against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from titlelens.llm import bloom, spelling
from titlelens.llm.queries import QUERIES
from titlelens.llm.spelling import spoilt_words, variants, words

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def plain_words(docs):
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                yield run


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(all_words, min_count=5, ratio=5):
    counts = {w: n for w, n in Counter(all_words).items() if n >= min_count}
    near = {w: [] for w in counts}
    deleted = {}
    for w in counts:  # words that share themselves or a deletion may be near
        for part in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            deleted.setdefault(part, []).append(w)
    for group in deleted.values():
        for a in group:
            near[a] += [b for b in group if a != b and is_near(a, b)]
    form, rows = {}, {}
    for w, n in counts.items():
        best = min(((-counts[b], b) for b in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows[w] = (form[w], root, n, len(set(near[w])), counts[form[w]] if form[w] else None)
    return rows


def got(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def _corpus(seed=4):
    rng = random.Random(seed)
    stems = ["receive", "straße", "façade", "naïveté", "colour", "commission", "aaaaaa", "zzzzzzz",
             "ÿÿÿÿÿÿ", "separate" * 9]
    docs = []
    for i in range(400):
        out = []
        for _ in range(30):
            w = rng.choice(stems[:rng.randrange(1, len(stems) + 1)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1:], w[:p] + rng.choice("aeé÷z") + w[p:],
                                w[:p] + rng.choice("aeéÀz") + w[p + 1:]])
            out.append(rng.choice([w, w.upper() if w.isascii() else w, w.capitalize()]))
        docs.append((i if i % 7 else None, rng.choice([" ", "-", "1", "Ā"]).join(out)))
    chain = [(1000 + i, "planets " * 25 + "planetx " * (4 * (i < 10)) + "planetxy" * (i < 7))
             for i in range(12)]
    return docs + chain + [(1, None), (2, ""), (3, "tiny")]


def _frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_equals_all_pairs(spark):
    docs = _corpus()
    wanted = plain_variants(plain_words(docs))
    assert got(variants(spoilt_words(_frame(spark, docs)))) == wanted
    assert sum(r[0] is not None for r in wanted.values()) > 20
    assert any(r[0] is not None and r[1] != r[0] for r in wanted.values())


def test_many_rounds_and_parts_change_nothing(spark, monkeypatch):
    docs = _corpus(9)
    monkeypatch.setattr(spelling, "SHARD_WORDS", 20)
    monkeypatch.setattr(spelling, "ROUND_BYTES", 300)
    seen = []
    true = spelling._filters
    monkeypatch.setattr(spelling, "_filters", lambda v, s: seen.append(s) or true(v, s))
    assert got(variants(spoilt_words(_frame(spark, docs)))) == plain_variants(plain_words(docs))
    assert len(seen) > 2 and any(parts > 1 for s in seen for _, _, parts, _ in s)


def test_query_equals_plain_python(spark):
    data = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "text").collect()]
    df = QUERIES["op12_spelling_variants"](spark, data)
    assert sorted(df.columns) == ["form", "form_n", "n", "n_near", "root", "word"]
    assert got(df) == plain_variants(plain_words(docs))


def test_ties_nulls_repeated_rows_and_extra_columns(spark):
    text = "abcdef " * 5 + "abcdeg " * 25 + "abcdeh " * 25 + "xbcdef " * 4
    docs = [(None, text)] * 2 + [(None, None)]
    df = _frame(spark, docs).selectExpr("*", "1 word", "2 n", "3 near", "'x' form")
    result = got(variants(words(df)))
    assert result == plain_variants([w for _, t in docs for w in (t or "").split()])
    assert result["abcdef"] == ("abcdeg", "abcdeg", 10, 3, 50)


def test_no_words_and_very_long_ones(spark):
    assert got(variants(spoilt_words(_frame(spark, [])))) == {}
    assert got(variants(spoilt_words(_frame(spark, [(1, "some few words")])))) == {}
    long = "ab" * 4000
    texts = [long, long + "c", long[:-1] + "z"]
    docs = [(i, " ".join(texts)) for i in range(5)]
    result = got(variants(words(_frame(spark, docs))))
    assert {w: r[3] for w, r in result.items()} == {texts[0]: 2, texts[1]: 1, texts[2]: 1}


@pytest.mark.parametrize("length", [1, 6, 11])
def test_hashes_of_edits_are_those_of_the_words(length):
    rng = random.Random(length)
    some = ["".join(rng.choice("abcÿé") for _ in range(length)) for _ in range(50)]
    points = bloom.codes(some, length)

    def hash_of(word):
        return bloom.hashes(bloom.codes([word], len(word)))[0] if word else np.uint64(0)

    if length > 1:
        for word, place, hashed in bloom.deletions(points):
            made = [some[w][:p] + some[w][p + 1:] for w, p in zip(word, place)]
            assert hashed.tolist() == [hash_of(w) for w in made]
            assert len(set(zip(word, made))) == len(made)
            assert set(zip(word, made)) == {(i, w[:p] + w[p + 1:]) for i, w in enumerate(some)
                                            for p in range(length)}
    alphabet = np.array(spelling.ALPHABET, np.uint64)
    for word, place, new, hashed in bloom.replacements(points, alphabet):
        made = [some[w][:p] + chr(c) + some[w][p + 1:] for w, p, c in zip(word, place, new)]
        assert hashed.tolist() == [hash_of(w) for w in made]


def test_few_false_positives():
    rng = np.random.default_rng(2)
    held, other = rng.integers(0, 1 << 63, 50_000, np.uint64), rng.integers(0, 1 << 63, 200_000,
                                                                           np.uint64)
    held, other = bloom._mixed(held), bloom._mixed(other)
    bits = bloom.empty(len(held))
    bloom.add(bits, held)
    assert len(bloom.probe(bits, held)) == len(held)
    assert len(bloom.probe(bits, other)) < 0.002 * len(other)
