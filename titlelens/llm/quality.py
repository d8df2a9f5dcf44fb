"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad.  Its features describe the line and its neighbours; transitions tie
labels of adjacent lines.  The forward-backward pass gives each line's probability of being
good, and their mean, weighted by length, is what a document's quality rests on: a logistic
curve, fitted on the same sample, turns it into the score.

Lines have no labels of their own.  At first all have their document's; after a fit, lines of
bad documents that look good are relabelled, and the field is fitted again.

Fitting uses at most `SAMPLE` labelled rows that are not held out, chosen by a hash of their id;
only numbers about their lines reach the driver.  Every text is scored whole.

Edge cases: a null or empty text is one empty line; labels with a null are left out; without
labels, or with one class only, every score is the rate of label 1 (one half without any); each
row of a repeated document is scored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 4_000
# Texts of more lines are scored like others, but not fitted on.
FITTED_LINES = 1_000
HELD_OUT, FOLDS = 2, 4
GOOD = 0.7
ROUNDS, STEPS, RATE, PENALTY = 3, 120, 0.1, 1e-3
CHUNK_CELLS = 1 << 20
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_DIGITS = bytes(range(0x30, 0x3A))
_SPACES = bytes([0x20, *range(0x09, 0x0E)])
OWN_FEATURES = 14


def _line(line: bytes, seen: set[bytes]) -> list[float]:
    """What a line looks like.  seen: the document's lines before it."""
    n = len(line)
    letters = n - len(line.translate(None, _LETTERS))
    upper = n - len(line.translate(None, _UPPER))
    digits = n - len(line.translate(None, _DIGITS))
    spaces = n - len(line.translate(None, _SPACES))
    marks = n - letters - digits - spaces
    words = line.split()
    k = max(1, len(words))
    again = line in seen
    if n > 8:
        seen.add(line)
    full = max(1, n)
    return [n == 0, math.log1p(n) / 5, letters / full, upper / max(1, letters), digits / full,
            marks / full, min(marks / k, 4), line.count(b"|") / k, line.count(b"!") / k,
            len(set(words)) / k, math.log1p(n / k), line[-1:] in b".!?" and n > 0, again,
            float(len(words) < 4)]


def text_lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A row of features per line, its own and its neighbours', and the lines' lengths."""
    lines = (text or "").encode("utf-8", "replace").split(b"\n")
    seen: set[bytes] = set()
    own = np.array([_line(x, seen) for x in lines], np.float64)
    none = np.zeros((1, OWN_FEATURES))
    before, after = np.vstack([none, own[:-1]]), np.vstack([own[1:], none])
    edge = np.zeros((len(own), 2))
    edge[0, 0] = edge[-1, 1] = 1
    ones = np.ones((len(own), 1))
    return (np.hstack([own, before, after, edge, ones]),
            np.array([max(1, len(x)) for x in lines], np.float64))


N_FEATURES = 3 * OWN_FEATURES + 3


class Field:
    """weights: log odds of good from the features; ties: what a label gives the next one."""

    def __init__(self, weights: np.ndarray, ties: np.ndarray, curve: tuple[float, float]):
        self.weights, self.ties, self.curve = weights, ties, curve

    def marginals(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """The probability of good for each line of each text."""
        out: list[np.ndarray] = [None] * len(texts)
        for chunk in _chunks([len(x) for x in texts]):
            odds, mask = _padded([texts[i] @ self.weights for i in chunk])
            good, _ = _forward_backward(odds, mask, self.ties)
            for column, i in enumerate(chunk):
                out[i] = good[:len(texts[i]), column]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.curve[1])
        made = [text_lines(t) for t in texts]
        means = [float(p @ size / size.sum())
                 for p, (_, size) in zip(self.marginals([m[0] for m in made]), made)]
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * np.array(means) + b, -40, 40)))


def _chunks(lengths: list[int]) -> Iterator[list[int]]:
    """Texts of like length together, so that little is padded."""
    held: list[int] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if held and (len(held) + 1) * lengths[i] > CHUNK_CELLS:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def _padded(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, columns))
    values = np.zeros((longest, len(columns)))
    mask = np.zeros(values.shape, bool)
    for i, column in enumerate(columns):
        values[:len(column), i] = column
        mask[:len(column), i] = True
    return values, mask


def _forward_backward(odds: np.ndarray, mask: np.ndarray, ties: np.ndarray):
    """Marginals of good, and the expected number of each transition, over padded columns."""
    t, n = odds.shape
    tie = np.exp(ties - ties.max())
    high = np.maximum(odds, 0)
    emit = np.stack([np.exp(-high), np.exp(odds - high)], axis=2)  # bad, good
    ahead = np.empty((t, n, 2))
    ahead[0] = emit[0] / emit[0].sum(1, keepdims=True)
    for i in range(1, t):
        now = (ahead[i - 1] @ tie) * emit[i]
        now /= now.sum(1, keepdims=True)
        ahead[i] = np.where(mask[i][:, None], now, ahead[i - 1])
    back = np.ones((t, n, 2))
    moves = np.zeros((2, 2))
    for i in range(t - 2, -1, -1):
        later = emit[i + 1] * back[i + 1]
        inside = mask[i + 1]
        if inside.any():
            both = ahead[i][:, :, None] * tie[None] * later[:, None, :]
            both /= both.sum((1, 2), keepdims=True)
            moves += both[inside].sum(0)
        now = later @ tie.T
        now /= now.sum(1, keepdims=True)
        back[i] = np.where(inside[:, None], now, 1.0)
    found = ahead * back
    good = found[:, :, 1] / found.sum(2)
    return np.where(mask, good, 0.0), moves


def _fit_field(texts: list[np.ndarray], labels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood by Adam, over all texts at each step."""
    weights, ties = np.zeros(N_FEATURES), np.zeros((2, 2))
    chunks = [(chunk, np.vstack([texts[i] for i in chunk])) for chunk in _chunks(
        [len(x) for x in texts])]
    lines = sum(map(len, texts))
    wanted_moves = np.zeros((2, 2))
    for y in labels:
        np.add.at(wanted_moves, (y[:-1], y[1:]), 1)
    first, second = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for step in range(1, STEPS + 1):
        gradient, moves = PENALTY * weights * lines, -wanted_moves + PENALTY * ties * lines
        for chunk, x in chunks:
            flat = x @ weights
            cuts = np.cumsum([len(texts[i]) for i in chunk])[:-1]
            odds, mask = _padded(np.split(flat, cuts))
            good, found = _forward_backward(odds, mask, ties)
            p = np.concatenate([good[:len(texts[i]), c] for c, i in enumerate(chunk)])
            y = np.concatenate([labels[i] for i in chunk])
            gradient = gradient + x.T @ (p - y)
            moves = moves + found
        g = np.concatenate([gradient, moves.ravel()]) / lines
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        move = RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        weights = weights - move[:N_FEATURES]
        ties = ties - move[N_FEATURES:].reshape(2, 2)
    return weights, ties


def _fit_curve(means: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """A rising logistic curve by Newton's method, lightly held."""
    x = np.stack([means, np.ones(len(means))], 1)
    w = np.array([4.0, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        scale = np.maximum(p * (1 - p), 1e-6)
        w = w - np.linalg.solve((x * scale[:, None]).T @ x + 0.02 * np.eye(2),
                                x.T @ (p - labels) + 0.02 * w)
    return float(max(w[0], 0.0)), float(w[1])


def fit_field(texts: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray) -> Field:
    """labels: 1 for good documents."""
    if not len(labels) or labels.min() == labels.max():
        return Field(None, None, (0.0, float(labels.mean()) if len(labels) else 0.5))
    lines = [np.full(len(x), y, np.int64) for x, y in zip(texts, labels)]
    for _ in range(ROUNDS):
        weights, ties = _fit_field(texts, lines)
        field = Field(weights, ties, (1.0, 0.0))
        found = field.marginals(texts)
        for i, p in enumerate(found):
            if labels[i] == 0:
                # The least likely line stays bad.
                lines[i] = ((p > 0.5) & (p > p.min())).astype(np.int64)
    means = np.array([float(p @ s / s.sum()) for p, s in zip(found, sizes)])
    return Field(weights, ties, _fit_curve(means, labels.astype(float)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, n: int = SAMPLE) -> Field:
    few = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
           .na.drop().filter(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(n))
    rows = docs.select("doc_id", "text").join(
        F.broadcast(few), F.col("doc_id") == F.col("id")).select(
        "id", F.xxhash64("doc_id", "text").alias("row"), "label", "text").filter(
        F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)) < FITTED_LINES)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_lines(t.as_py()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3],
                 pa.array([x.astype("<f4").tobytes() for x, _ in found], pa.binary()),
                 pa.array([s.astype("<f8").tobytes() for _, s in found], pa.binary())],
                names=["id", "row", "label", "features", "sizes"])

    kind = few.schema["id"].dataType.simpleString()
    made_rows = rows.mapInArrow(
        made, f"id {kind}, row long, label int, features binary, sizes binary")
    # Of each id one text, so there are no more rows than labels, however often an id is there.
    one = F.min_by(F.struct("row", "label", "features", "sizes"), "row").alias("one")
    held = made_rows.groupBy("id").agg(one).select("one.*").toPandas()
    held = held.sort_values("row", kind="stable")
    return fit_field([np.frombuffer(x, "<f4").reshape(-1, N_FEATURES).astype(float)
                      for x in held["features"]],
                     [np.frombuffer(s, "<f8") for s in held["sizes"]],
                     held["label"].to_numpy(np.int64))


def assess(docs: DataFrame, labels: DataFrame, good: float = GOOD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`."""
    field = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array(field.scores(part.column(2).to_pylist()), pa.float64())],
                    names=["doc_id", "held_out", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= good).cast("int"))
