"""Spelling variants: words one edit apart, found through Bloom filters of the vocabulary.

The vocabulary is counted by a grouping with a map-side part.  Two words are near if they differ
by one inserted, deleted or replaced code point.  Each word generates its deletions, and its
replacements by greater code points: the other edits are these seen from the other word.  An edit
is probed in the filter of the words of its length (`bloom`); only what passes is made as text
and joined with the vocabulary, which removes the false positives.

Filters are built by Spark, a shard of about `SHARD_WORDS` words of one length in one task, and
broadcast: at most `ROUND_BYTES` at once.  A larger vocabulary takes more rounds, each with the
shards of some lengths or, of a single length, with some of its parts; in every round only words
of lengths that can have edits there probe.  So the broadcast is bounded, and nothing is left out.

A word's form is the near word of largest count, if that is `RATIO` times the word's or more.
Counts rise along forms by that factor, so chains are short: their ends are found by a number of
joins that doubles the reach each time.

Edge cases: a null text has no words; a null id counts as an empty text in the checksum; repeated
rows count again; words of any length are compared; equal counts go to the smallest near word in
code-point order; an empty table, or one without frequent words, gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm import bloom
from titlelens.llm.common import ascii_lower, stored
from titlelens.plans.scratch import scratch_path

# What a word is made of, in lower case.
LETTERS = "a-zÀ-ÿ"
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
SPOILT_EVERY = 199
# One filter takes two bytes a word.
SHARD_WORDS = 1 << 18
ROUND_BYTES = 1 << 24
# Lengths from here on share their filters, so that there are few kinds of shards.
LONG = 48
PROBED_WORDS = 256


def words(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, word: the maximal runs of letters of `min_length` or more, A-Z lowered."""
    runs = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))),
                                F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("word"))


def spoilt_words(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """word: as `words`, but of some runs, told by a checksum, one code point is left out."""
    runs = words(docs, min_length)
    told = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word")
    place = (F.col("h") % F.length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), place),
                       F.substring("word", place + 2, F.length("word")))
    return (runs.withColumn("h", F.crc32(told))
            .select(F.when(F.col("h") % SPOILT_EVERY == 0, shorter).otherwise(F.col("word"))
                    .alias("word"))
            .filter(F.length("word") >= min_length))


def vocabulary(found: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n, length of the words that occur often enough."""
    return (found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
            .withColumn("length", F.length("word")))


# --- filters -----------------------------------------------------------------------------------

def _shard_class(length: int) -> int:
    return min(length, LONG)


def _by_length(strings: list[str]) -> dict[int, list[int]]:
    places = defaultdict(list)
    for i, word in enumerate(strings):
        places[len(word)].append(i)
    return places


def _hashed(strings: list[str]) -> np.ndarray:
    out = np.zeros(len(strings), np.uint64)
    for length, places in _by_length(strings).items():
        step = max(1, bloom.EDITS_AT_ONCE // length)
        for at in range(0, len(places), step):
            some = places[at:at + step]
            out[some] = bloom.hashes(bloom.codes([strings[i] for i in some], length))
    return out


def _shards(counts: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(class, part, parts, words at most) of all shards, by class."""
    shards = []
    for kind, n in sorted(counts.items()):
        parts = -(-n // SHARD_WORDS)
        shards += [(kind, part, parts, min(n, SHARD_WORDS)) for part in range(parts)]
    return shards


def _rounds(shards: list[tuple[int, int, int, int]]) -> Iterator[list[tuple[int, int, int, int]]]:
    """Shards together that are not more than is broadcast at once."""
    some, held = [], 0
    for shard in shards:
        size = bloom.empty(shard[3]).nbytes
        if some and held + size > ROUND_BYTES:
            yield some
            some, held = [], 0
        some.append(shard)
        held += size
    if some:
        yield some


def _filters(vocab: DataFrame, shards: list[tuple[int, int, int, int]]
             ) -> dict[tuple[int, int], tuple[int, bytes]]:
    """(class, part) -> (parts, filter), each built by one task from a stream of words."""
    sizes = {(kind, part): (parts, size) for kind, part, parts, size in shards}
    parts_of = {kind: parts for kind, _, parts, _ in shards}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column(0).to_pylist()
            hashed = _hashed(strings)
            kinds = np.array([_shard_class(len(w)) for w in strings], np.int64)
            parts = np.array([parts_of[k] for k in kinds.tolist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(bloom.slice_of(hashed, parts.astype(np.uint64))),
                 pa.array(hashed.view(np.int64))], names=["kind", "part", "hashed"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            kinds, parts = (batch.column(i).to_numpy() for i in range(2))
            hashed = batch.column(2).to_numpy().view(np.uint64)
            for kind, part in set(zip(kinds.tolist(), parts.tolist())):
                if (kind, part) in sizes:
                    if (kind, part) not in held:
                        held[kind, part] = bloom.empty(sizes[kind, part][1])
                    bloom.add(held[kind, part], hashed[(kinds == kind) & (parts == part)])
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in held], pa.int64()),
                 pa.array([p for _, p in held], pa.int64()),
                 pa.array([f.tobytes() for f in held.values()])], names=["kind", "part", "bits"])

    wanted = vocab.filter(_class_of("length").isin(*parts_of)).select("word")
    rows = (wanted.mapInArrow(placed, "kind long, part long, hashed long")
            .repartition("kind", "part").mapInArrow(build, "kind long, part long, bits binary"))
    # Bounded: the filters of one round.
    return {(r["kind"], r["part"]): (sizes[r["kind"], r["part"]][0], bytes(r["bits"]))
            for r in rows.toLocalIterator()}


def _class_of(length: str) -> Column:
    return F.least(F.col(length), F.lit(LONG))


def _passed(held: dict[tuple[int, int], tuple[int, np.ndarray]], length: int,
            hashed: np.ndarray) -> np.ndarray:
    """Places of the hashes of words of one length that a filter of this round lets pass."""
    kind, out = _shard_class(length), []
    filters = {part: f for (k, part), f in held.items() if k == kind}
    if not filters or not len(hashed):
        return np.zeros(0, np.int64)
    parts = next(iter(filters.values()))[0]
    of = bloom.slice_of(hashed, parts) if parts > 1 else None
    for part, (_, bits) in filters.items():
        mine = None if of is None else np.flatnonzero(of == part)
        hits = bloom.probe(bits, hashed if mine is None else hashed[mine])
        out.append(hits if mine is None else mine[hits])
    return np.concatenate(out)


def _edits(strings: list[str], length: int, held: dict) -> Iterator[tuple[int, str]]:
    """(place of the word, edited word) of the edits that pass."""
    points = bloom.codes(strings, length)
    for word, place, hashed in bloom.deletions(points):
        for i in _passed(held, length - 1, hashed).tolist():
            w, p = strings[word[i]], place[i]
            yield int(word[i]), w[:p] + w[p + 1:]
    for word, place, new, hashed in bloom.replacements(points, np.array(ALPHABET, np.uint64)):
        for i in _passed(held, length, hashed).tolist():
            w, p = strings[word[i]], place[i]
            yield int(word[i]), w[:p] + chr(int(new[i])) + w[p + 1:]


def _positives(vocab: DataFrame, filters: Broadcast) -> DataFrame:
    """word, n, near: edits that are in a filter."""
    kinds = {kind for kind, _ in filters.value}

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {key: (parts, np.frombuffer(bits, np.uint32))
                for key, (parts, bits) in filters.value.items()}
        for batch in batches:
            strings, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, places in _by_length(strings).items():
                for at in range(0, len(places), PROBED_WORDS):
                    some = places[at:at + PROBED_WORDS]
                    found = list(_edits([strings[i] for i in some], length, held))
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([strings[some[i]] for i, _ in found]),
                             pa.array([counts[some[i]] for i, _ in found], pa.int64()),
                             pa.array([near for _, near in found])], names=["word", "n", "near"])

    # A word probes filters of its own length and of the next shorter one.
    asked = sorted(kinds | {kind + 1 for kind in kinds if kind < LONG})
    return vocab.filter(_class_of("length").isin(*asked)).select("word", "n").mapInArrow(
        probe, "word string, n long, near string")


# --- near words, forms and roots ---------------------------------------------------------------

def near_pairs(vocab: DataFrame) -> DataFrame:
    """word, n, near, near_n: both directions of all pairs.  `vocab` is a stored table."""
    spark = vocab.sparkSession
    counts = {r["kind"]: r["words"] for r in vocab.groupBy(_class_of("length").alias("kind")).agg(
        F.count("*").alias("words")).collect()}  # at most LONG rows
    path, empty = scratch_path(spark, "edits"), True
    for shards in _rounds(_shards(counts)):
        filters = spark.sparkContext.broadcast(_filters(vocab, shards))
        _positives(vocab, filters).write.mode("append").parquet(path)
        filters.unpersist()
        empty = False
    ddl = "word string, n long, near string"
    positives = (spark.createDataFrame([], ddl) if empty else spark.read.schema(ddl).parquet(path))
    known = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = positives.join(known, "near").select("word", "n", "near", "near_n")
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
        F.col("n").alias("near_n"))))
    return pairs.select(both.alias("pair")).select("pair.*")


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """word, root of all words with a form, where chains have at most `steps` links."""
    reached = forms.select("word", F.col("form").alias("root"))
    for i in range(math.ceil(math.log2(max(1, steps)))):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        reached = stored(reached.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root")), f"roots{i}")
    return reached


def variants(found: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary of `found`.word."""
    vocab = stored(vocabulary(found, min_count), "vocabulary")
    largest = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("largest")
    # A word has at most some hundred near words for each of its letters.
    near = near_pairs(vocab).groupBy("word").agg(F.count("*").alias("n_near"), largest)
    chosen = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.col("largest.near").alias("near"), (-F.col("largest.less")).alias("near_n"))
    is_form = F.col("near_n") >= F.col("n") * ratio
    words = stored(chosen.select(
        "word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log(max(1.0, most / min_count), ratio)) + 1
    roots = _roots(words.filter("form is not null"), steps)
    return words.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
