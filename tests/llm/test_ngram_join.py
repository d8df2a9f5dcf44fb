"""N-gram Jaccard join against all pairs in plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from titlelens.llm import components, ngram_join, shingles, trie

LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


def plain_set(text):
    ws = (text or "").encode().translate(LOWER).split()
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4)))


def plain_components(docs):
    sets = [plain_set(t) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if label[j] == label[i]
               and docs[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids and sets[i] else doc_id))
    return sorted(out, key=str)


def corpus(seed, n=120):
    """Copies with edits from none to many, shared passages, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("xyz")
    passage = " ".join(word() for _ in range(40))
    bases = [" ".join(word() for _ in range(rng.choice([3, 5, 8, 30, 80]))) for _ in range(12)]
    docs = []
    for i in range(n):
        ws = rng.choice(bases).split()
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            ws[rng.randrange(len(ws))] = word()
        if rng.random() < 0.3:
            ws += passage.split()
        docs.append((i, " ".join(ws)))
    docs += [(500, None), (501, ""), (502, " \n\t "), (503, None), (None, bases[0]),
             (504, bases[1].upper()), (505, "\x0b".join(bases[2].split())), docs[5], docs[5],
             (506, "one"), (507, "One"), (508, "a b"), (509, "a b")]
    return docs


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICE", 3)
    monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 30)


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_pairs(spark, seed):
    docs = corpus(seed)
    frame = spark.createDataFrame([(*d, 1, "x", 2) for d in docs],
                                  "doc_id long, text string, n int, cls string, block int")
    got = ngram_join.similar(frame).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_components(docs)
    kept = ngram_join.keep_one(frame)
    assert kept.columns == frame.columns
    rows = [r["doc_id"] for r in kept.collect()]
    want = plain_components(docs)
    with_words = {c for d, n, c in want if n}
    bare = sum(1 for d, n, c in want if not n)
    assert len(rows) == len(with_words) + bare


@pytest.mark.parametrize("docs,want", [
    ([(None, "a b c d e f"), (None, "g h i j k l")], 2),  # unlike, null ids
    ([(7, "a b c d e f"), (7, "g h i j k l")], 2),  # unlike, one id
    ([(None, "a b c d e f"), (None, "a b c d e f")], 1),  # equal rows
    ([(None, "a b"), (None, "A  b"), (7, "a b"), (7, "c"), (None, "c"), (None, None), (None, None)],
     4),
])
def test_one_row_of_each_group_whatever_the_ids(spark, docs, want):
    kept = ngram_join.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(kept) == want
    worded = {" ".join(t.lower().split()) for _, t in docs if t}
    assert {" ".join(r["text"].lower().split()) for r in kept if r["text"]} == worded


def test_frequent_elements_and_slices(spark, small):
    """With limits so low that nearly all is frequent and blocks are cut in many slices."""
    docs = corpus(7)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = ngram_join.similar(frame).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_components(docs)


def test_no_task_holds_a_whole_block(spark, monkeypatch):
    """A block of texts that share a frequent passage and are mostly not similar."""
    monkeypatch.setattr(ngram_join, "SLICE", 10)
    monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 30)
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(84))
    docs = [(i, f"{passage} " + " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(24)))
            for i in range(100)]
    docs += [(200 + i, f"{t} more") for i, t in docs[:7]]
    most, joined = [], ngram_join._joined

    def watched(sets, percent):
        most.append(sets.groupBy("block", "slice").count().agg({"count": "max"}).first()[0])
        return joined(sets, percent)

    monkeypatch.setattr(ngram_join, "_joined", watched)
    got = ngram_join.similar(spark.createDataFrame(docs, "doc_id long, text string")).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_components(docs)
    assert len(most) == 2 and most[1] <= 50


def test_no_pairs_where_a_crowd_meets(spark, monkeypatch):
    """Texts that share a passage too rare to be found frequent, some of them similar."""
    monkeypatch.setattr(ngram_join, "CROWD", 5, raising=False)
    monkeypatch.setattr(ngram_join, "LEAST_LOCAL", 1 << 30)
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(60)) + f" {passage}")
            for i in range(120)]
    docs += [(200 + i, f"{t} more") for i, (_, t) in enumerate(docs[:9])]
    docs += [(300 + i, f"{passage} x{i}") for i in range(12)]
    written, stored = [], ngram_join.stored

    def counted(df, label):
        out = stored(df, label)
        if label == "meeting":
            written.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    got = ngram_join.similar(spark.createDataFrame(docs, "doc_id long, text string")).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_components(docs)
    # Some 20 elements a prefix; all pairs would be 120 * 119 / 2 rows at least.
    assert sum(written) < 5000


def test_the_last_round_leaves_no_crowd_out(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", 2)
    monkeypatch.setattr(ngram_join, "ROUNDS", 2)
    monkeypatch.setattr(ngram_join, "LEAST_LOCAL", 1 << 30)
    docs = corpus(8)
    got = ngram_join.similar(spark.createDataFrame(docs, "doc_id long, text string")).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_components(docs)


def test_texts_beyond_what_is_sent(spark, monkeypatch):
    """Rows to read again are too many to be sent: only texts that may be among them are dealt."""
    monkeypatch.setattr(ngram_join, "MAX_SENT", 0)
    docs = corpus(9)
    frame = spark.createDataFrame([(i, t, str(i)) for i, t in docs],
                                  "doc_id int, text string, row string")
    got = ngram_join.similar(frame).select("doc_id", "n_shingles", "component_id").collect()
    want = plain_components(docs)
    assert sorted(map(tuple, got), key=str) == want
    kept = ngram_join.keep_one(frame)
    assert kept.columns == frame.columns
    assert kept.count() == len({c for _, n, c in want if n}) + sum(1 for _, n, _ in want if not n)


def test_sieve_passes_all_that_it_must_and_few_others(spark):
    keys = spark.range(30_000).selectExpr("xxhash64(id) AS key")
    some = keys.limit(2000).localCheckpoint()
    among = ngram_join._sieve(some, 2000)
    assert some.filter(among("key")).count() == 2000
    assert 2000 <= keys.filter(among("key")).count() < 2200
    none = ngram_join._sieve(some.limit(0), 0)
    assert keys.filter(none("key")).count() == 0


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar(frame).count() == 0
    assert ngram_join.keep_one(frame).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_trie_connects_what_is_similar(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 60, 30)
    sets = []
    for _ in range(25):
        s = base.copy()
        s[rng.integers(0, 30, rng.integers(0, 8))] = rng.integers(0, 200)
        sets.append(np.unique(s[:rng.integers(15, 31)]).astype(np.int64))
    found = trie.connect(sets)

    def groups(links):
        label = list(range(len(sets)))
        for i, j in links:
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
        return {frozenset(k for k in range(len(sets)) if label[k] == x) for x in label}

    similar = []
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                similar.append((i, j))
    assert groups(found) == groups(similar)
    assert all(tuple(sorted(x, reverse=True)) in set(similar) for x in found)


def test_texts_in_pieces_give_the_same_sets(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\té") for _ in range(n)) for n in (0, 1, 50, 5000, 20_000)]
    texts += [None, "x" * 3000]
    whole = [v.tolist() for v in shingles.text_sets(pa.array(texts))]
    assert [len(v) for v in whole] == [len(plain_set(t)) for t in texts]
    for size in (16, 100, 1000):
        monkeypatch.setattr(shingles, "PIECE_BYTES", size)
        assert [v.tolist() for v in shingles.text_sets(pa.array(texts).slice(0))] == whole
        assert [v.tolist() for v in shingles.text_sets(pa.array(texts).slice(2))] == whole[2:]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)]
    label = {x: x for ab in links for x in ab}
    for a, b in links:
        low, high = sorted((label[a], label[b]))
        label = {k: low if v == high else v for k, v in label.items()}
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["label"] for r in got.collect()} == {
        k: v for k, v in label.items() if k in linked}
