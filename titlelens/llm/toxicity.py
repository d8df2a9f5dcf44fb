"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other.  Each has a logistic model on which telling tokens
(words, beginnings that one word or several have, runs of punctuation) a text has, and on the probabilities of the
categories before it.  While fitting, those come from models that have not seen the row
(out-of-fold), so that a later model learns how far the earlier ones can be trusted.

Fitting uses at most `SAMPLE` labelled rows, chosen by a hash of their id; telling tokens are
counted by Spark over that sample, and only those reach the driver.  Every text is scored whole.

Edge cases: a null or empty text has no tokens and gets the models' base rates; a category with
one class only gets a constant; labels with a null are left out; without labels nothing is
toxic; each row of a repeated document is scored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import stored

SAMPLE = 12_000
TOKENS = 512
FOLDS = 4
PENALTY = 0.3
REJECT = 0.5
# In the order of the chain: 0/1 expressions over the labels.
CATEGORIES = {"junk": "1 - quality", "toxic": "toxic", "toxic_junk": "toxic * (1 - quality)"}
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+")
_STARTS = (4, 5, 6, 7, 8)


def _starts_of(words: set[str], n: int, known: set[str] | None = None) -> set[str]:
    """`^` and the first n letters of longer words; `^^` and those that two words begin with."""
    starts = [w[:n] for w in words if len(w) > n]
    counts = Counter(starts if known is None else [s for s in starts if s in known])
    return {"^" + s for s in counts} | {"^^" + s for s, k in counts.items() if k > 1}


def _shown(word: str) -> str:
    """A long word as a hash of the whole of it."""
    return word if len(word) <= 64 else "#" + hashlib.sha1(word.encode()).hexdigest()


def text_tokens(text: str | None) -> set[str]:
    words = set(_TOKEN.findall((text or "").lower()))
    found = {_shown(w) for w in words if w[0] != "^"}
    for n in _STARTS:
        found |= _starts_of(words, n)
    return found


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            found = [sorted(text_tokens(t.as_py())) for t in part.column(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(found, pa.list_(pa.string()))],
                names=[*part.schema.names[:-1], "tokens"])


def sample(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, n: int = SAMPLE) -> DataFrame:
    """A row per sampled document: its number, a 0/1 column per category, its tokens; stored."""
    flags = [F.expr(e).cast("int").alias(f"is_{c}") for c, e in categories.items()]
    few = (labels.select(F.col("doc_id").alias("id"), *flags).na.drop()
           .orderBy(F.xxhash64("id"), "id").limit(n))
    rows = docs.select("doc_id", "text").join(
        F.broadcast(few), F.col("doc_id") == F.col("id")).select(
        "id", F.xxhash64("doc_id", "text").alias("row"), *[f"is_{c}" for c in categories], "text")
    kind = few.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, row long, " + ", ".join(
        f"is_{c} int" for c in categories) + ", tokens array<string>"
    # Of each id one text, so there are no more rows than labels, however often an id is there.
    found = rows.mapInArrow(_tokens_of, ddl)
    one = F.min_by(F.struct(*found.columns[1:]), "row").alias("one")
    return stored(found.groupBy("id").agg(one).select("one.*"), "toxicity-sample")


def telling_tokens(rows: DataFrame, category: str, n: int = TOKENS) -> list[str]:
    """The tokens whose presence says most about a category, by the z score of their log odds."""
    flag = F.col(f"is_{category}")
    with_it, without = rows.agg(F.sum(flag), F.sum(1 - flag)).first()
    if not with_it or not without:
        return []
    yes, no = F.sum(flag) + 0.5, F.sum(1 - flag) + 0.5
    odds = F.log(yes / (with_it + 1 - yes)) - F.log(no / (without + 1 - no))
    scored = (rows.select(flag, F.explode("tokens").alias("token")).groupBy("token")
              .agg(F.abs(odds / F.sqrt(1 / yes + 1 / no)).alias("z"), F.count("*").alias("n")))
    best = scored.filter("n > 1").orderBy(F.desc(F.round("z", 9)), "token").limit(n)
    return [r["token"] for r in best.collect()]


def _probability(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights, the last for the constant; by Newton's method, with steps that never go uphill."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(rate / (1 - rate))
    if not len(y) or y.min() == y.max():
        return w
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6

    def loss(weights: np.ndarray) -> float:
        z = x @ weights
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (ridge * weights) @ weights)

    now = loss(w)
    for _ in range(25):
        p = _probability(x @ w)
        scale = np.maximum(p * (1 - p), 1e-5)
        step = np.linalg.solve(((x * scale[:, None].astype(x.dtype)).T @ x).astype(float)
                               + np.diag(ridge), x.T @ (p - y) + ridge * w)
        # Rows that can be told apart invite steps that are too long.
        for _ in range(20):
            after = loss(w - step)
            if after <= now:
                break
            step = step / 2
        else:
            break
        done = now - after < 1e-4 * max(1.0, after)
        w, now = w - step, after
        if done:
            break
    return w


class Chain:
    """The fitted models: for each category its tokens and weights, in order."""

    def __init__(self, models: list[tuple[str, list[str], np.ndarray]]):
        self.models = models
        self.places: dict[str, list[tuple[int, float]]] = {}
        for i, (_, tokens, weights) in enumerate(models):
            for token, w in zip(tokens, weights):
                self.places.setdefault(token, []).append((i, float(w)))
        self.whole = {t for t in self.places if not t.startswith("^")}
        self.starts = [(n, {t.lstrip("^") for t in self.places
                            if t[0] == "^" and len(t.lstrip("^")) == n}) for n in _STARTS]

    def scores(self, text: str | None) -> list[float]:
        words = set(_TOKEN.findall((text or "").lower()))
        found = {_shown(w) for w in words} & self.whole
        for n, known in self.starts:
            if known:
                found |= _starts_of(words, n, known)
        sums = [0.0] * len(self.models)
        for token in sorted(found):
            for i, w in self.places.get(token, ()):
                sums[i] += w
        done: list[float] = []
        for (_, tokens, weights), total in zip(self.models, sums):
            x = total + float(weights[-1]) + sum(
                float(w) * p for w, p in zip(weights[len(tokens):-1], done))
            done.append(float(_probability(np.array(x))))
        return done


def presence(places: Sequence, wanted: list[int]) -> np.ndarray:
    """A 0/1 row for each list of places, with a column for each one wanted: of one category's
    tokens at a time, as all of them take several times the driver's memory."""
    column = {p: i for i, p in enumerate(wanted)}
    x = np.zeros((len(places), len(wanted)), np.float32)
    for i, at in enumerate(places):
        x[i, [column[p] for p in at if p in column]] = 1
    return x


def fit(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, n: int = SAMPLE) -> Chain:
    rows = sample(docs, labels, categories, n)
    tokens = {c: telling_tokens(rows, c) for c in categories}
    known = {t for ts in tokens.values() for t in ts}
    place = {t: i for i, t in enumerate(sorted(known))}
    index = rows.sparkSession.sparkContext.broadcast(place)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[index.value[t] for t in ts if t in index.value]
                     for ts in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(
                found, pa.list_(pa.int32()))], names=[*batch.schema.names[:-1], "places"])

    ddl = "row long, " + ", ".join(f"is_{c} int" for c in categories) + ", places array<int>"
    # At most `n` rows of at most the telling tokens.
    held = rows.mapInArrow(places, ddl).toPandas().sort_values("row", kind="stable")
    folds = np.arange(len(held)) % FOLDS
    models, earlier = [], np.zeros((len(held), 0), np.float32)
    for category in categories:
        y = held[f"is_{category}"].to_numpy(float)
        seen = np.hstack([presence(held["places"], [place[t] for t in tokens[category]]), earlier])
        unseen = np.zeros(len(held), np.float32)
        for fold in range(FOLDS):
            out = folds == fold
            w = fit_logistic(seen[~out], y[~out])
            unseen[out] = _probability(seen[out] @ w[:-1] + w[-1])
        models.append((category, tokens[category], fit_logistic(seen, y)))
        earlier = np.hstack([earlier, unseen[:, None]])
    return Chain(models)


def _scored(chain: Chain, category: str | None = None) -> Callable[[Column], Column]:
    """The probabilities of a text column; whole Arrow batches, one text at a time."""
    names = [c for c, _, _ in chain.models]

    def run(texts: pa.Array) -> pa.Array:
        found = np.array([chain.scores(t.as_py()) for t in texts], float).reshape(-1, len(names))
        columns = [pa.array(found[:, i]) for i in range(len(names))]
        if category:
            return columns[names.index(category)]
        return pa.StructArray.from_arrays(columns, names=[f"p_{c}" for c in names])

    kind = "double" if category else f"struct<{', '.join(f'p_{c}: double' for c in names)}>"
    return F.arrow_udf(run, kind)


def toxic_probability(chain: Chain, text: Column) -> Column:
    return _scored(chain, "toxic")(text)


def classify(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """doc_id, a probability p_<category> each, and rejected: p_toxic reaches `reject`."""
    chain = fit(docs, labels)
    found = docs.select("doc_id", _scored(chain)(F.col("text")).alias("p")).select("doc_id", "p.*")
    return found.withColumn("rejected", F.col("p_toxic") >= reject)


def drop_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of `docs` that are not rejected, with all their columns."""
    return docs.filter(toxic_probability(fit(docs, labels), docs["text"]) < reject)
