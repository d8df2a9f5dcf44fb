"""Toxicity chain and line field: held-out accuracy, odd rows, and the field against sums over
all labellings."""

import itertools
import os

import numpy as np
import pytest

from titlelens.llm import quality, toxicity

DATA = os.environ.get("TITLELENS_DATA", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels")]


def test_toxic_rows_that_were_not_seen(spark, tables):
    docs, labels = tables
    seen = labels.filter("doc_id % 4 != 1")
    rows = (toxicity.classify(docs, seen).join(labels.filter("doc_id % 4 = 1"), "doc_id")
            .collect())
    right = [r["rejected"] == bool(r["toxic"]) for r in rows]
    assert np.mean(right) > 0.9  # of some 40 toxic rows to learn from, in four languages
    assert not [r for r in rows if r["rejected"] and not r["toxic"]]
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 800 < kept.count() < 1000


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "you awful idiot", 1), (2, "a fine day", 2), (3, None, 3), (4, "", 4), (4, "", 4),
         (None, "awful idiot", 5), (5, "word " * 50_000 + "idiot", 6)],
        "doc_id long, text string, p_toxic int")
    labels = spark.createDataFrame(
        [(1, 1, 1, "x"), (2, 1, 0, "y"), (4, None, 0, "z"), (None, 1, 1, "n"), (9, 0, 0, "gone")],
        "doc_id long, quality int, toxic int, text string")
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == 7 and all(0 < r["p_toxic"] < 1 for r in rows)
    for none in (toxicity.classify(docs, labels.limit(0)), toxicity.classify(
            docs, labels.filter("toxic = 0"))):
        assert len(none.collect()) == 7
        assert not [r for r in none.collect() if r["rejected"] and r["p_toxic"] < 0.5]
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_later_models_use_earlier_probabilities():
    x = np.array([[0], [1]] * 50, np.float32)
    y = np.array([0, 1] * 50, float)
    w = toxicity.fit_logistic(x, y)
    assert w[0] > 2
    chain = toxicity.Chain([("a", ["t"], np.array([4.0, -2.0])),
                            ("b", [], np.array([3.0, -1.0]))])
    low, high = chain.scores("x"), chain.scores("t")
    assert high[0] > low[0] and high[1] > low[1]


def test_quality_of_held_out_rows(spark, tables):
    docs, labels = tables
    rows = quality.assess(docs, labels).join(labels, "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "A line.\nAnd one more.", 1), (2, "%%% !!!\n$$$", 2), (3, None, 3), (4, "", 4),
         (4, "", 4), (None, "no id", 5), (6, "line\n" * 30_000, 6)],
        "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1)],
                                   "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        rows = quality.assess(docs, known).collect()
        assert len(rows) == 7 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.assess(docs.limit(0), labels).count() == 0


def test_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(2)
    ties = rng.normal(size=(2, 2))
    texts = [rng.normal(size=n) for n in (1, 4, 6)]
    odds, mask = quality._padded(texts)
    good, moves = quality._forward_backward(odds, mask, ties)
    want_moves = np.zeros((2, 2))
    for c, odd in enumerate(texts):
        total, on = 0.0, np.zeros(len(odd))
        all_moves = np.zeros((2, 2))
        for ys in itertools.product([0, 1], repeat=len(odd)):
            score = sum(o for o, y in zip(odd, ys) if y)
            weight = np.exp(score + sum(ties[a, b] for a, b in zip(ys, ys[1:])))
            total += weight
            on += weight * np.array(ys)
            for a, b in zip(ys, ys[1:]):
                all_moves[a, b] += weight
        assert good[:len(odd), c] == pytest.approx(on / total)
        want_moves += all_moves / total
    assert moves == pytest.approx(want_moves)


def _plain_telling(rows, flags, n):
    """The tokens of largest |log odds| / its error, from counts."""
    with_it, counts, total = sum(flags), {}, {}
    for tokens, flag in zip(rows, flags):
        for t in tokens:
            total[t] = total.get(t, 0) + 1
            counts[t] = counts.get(t, 0) + flag
    scored = []
    for t, k in total.items():
        yes, no = counts[t] + 0.5, k - counts[t] + 0.5
        odds = np.log(yes / (with_it + 1 - yes)) - np.log(no / (len(flags) - with_it + 1 - no))
        if k > 1:
            scored.append((-round(abs(odds / np.sqrt(1 / yes + 1 / no)), 9), t))
    return [t for _, t in sorted(scored)[:n]]


def _plain_logistic(x, y):
    """Gradient steps to the end, with no second derivatives."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], toxicity.PENALTY)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    step = 1 / (0.25 * np.linalg.norm(x, 2) ** 2 + toxicity.PENALTY)
    ahead, t = w, 1.0
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-x @ ahead))
        after = ahead - step * (x.T @ (p - y) + ridge * ahead)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = after + (t - 1) / s * (after - w), after, s
    return w


def test_chain_by_brute_force(spark):
    """Tokens by counting, models by plain descent, folds by hand: the same probabilities."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(30)]
    docs, labels = [], []
    for i in range(90):
        toxic, quality = int(rng.random() < 0.4), int(rng.random() < 0.5)
        text = list(rng.choice(words, 8)) + ["vile"] * (toxic and rng.random() < 0.8)
        text += ["spam"] * (not quality and rng.random() < 0.7)
        docs.append((i, " ".join(text)))
        labels.append((i, quality, toxic))
    docs += docs[:2] + [(200, None), (201, "vile spam w1")]  # repeated rows count once
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.classify(frame, marks).collect()}

    order = [r[0] for r in frame.filter("doc_id < 200").distinct().selectExpr(
        "doc_id", "xxhash64(doc_id, text) h").orderBy("h").collect()]
    texts, by_id = dict(docs), {i: (q, t) for i, q, t in labels}
    rows = [toxicity.text_tokens(texts[i]) for i in order]
    flags = {"junk": [1 - by_id[i][0] for i in order], "toxic": [by_id[i][1] for i in order],
             "toxic_junk": [by_id[i][1] * (1 - by_id[i][0]) for i in order]}
    folds = np.arange(len(order)) % toxicity.FOLDS
    earlier = np.zeros((len(order), 0))
    models = []
    for c, y in flags.items():
        telling, y = _plain_telling(rows, y, toxicity.TOKENS), np.array(y, float)
        x = np.hstack([np.array([[float(t in r) for t in telling] for r in rows]), earlier])
        unseen = np.zeros(len(order))
        for fold in range(toxicity.FOLDS):
            w = _plain_logistic(x[folds != fold], y[folds != fold])
            unseen[folds == fold] = 1 / (1 + np.exp(-(x[folds == fold] @ w[:-1] + w[-1])))
        models.append((telling, _plain_logistic(x, y)))
        earlier = np.hstack([earlier, unseen[:, None]])
    for i, text in {*docs}:
        done, have = [], toxicity.text_tokens(text)
        for (telling, w), c in zip(models, flags):
            z = w[-1] + sum(v for t, v in zip(telling, w) if t in have)
            z += sum(v * p for v, p in zip(w[len(telling):-1], done))
            done.append(1 / (1 + np.exp(-z)))
            assert got[i][f"p_{c}"] == pytest.approx(done[-1], abs=0.02)
        assert got[i]["rejected"] == (got[i]["p_toxic"] >= toxicity.REJECT)
    assert got[201]["rejected"] and len(got) == 92


def test_long_words_are_told_apart_by_their_ends():
    a, b = (toxicity.text_tokens("x" * 70 + end) for end in "ab")
    assert a != b and all(len(t) <= 64 for t in a | b)


def test_an_id_of_many_texts_is_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text number {i}") for i in range(500)] + [(2, "other")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.sample(docs, labels).count() == 2


def test_presence_has_only_the_wanted_tokens():
    x = toxicity.presence([[0, 2], [], [1, 3, 2]], [2, 3])
    assert x.dtype == np.float32 and x.tolist() == [[1, 0], [0, 0], [1, 1]]
    assert toxicity.presence([], [1]).shape == (0, 1)
    assert toxicity.presence([[4]], []).shape == (1, 0)
