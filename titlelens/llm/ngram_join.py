"""N-gram Jaccard join: which documents share three quarters of their five-word shingles.

1. Each text becomes a sorted set of hashed shingles; texts of equal set are one class.
2. Shingles that are frequent in the corpus come last in the global order, the others are ordered
   by hash.  Two similar sets share an element among the first quarter of each (the prefix).
3. Prefix elements meet by hash.  Where at most `CROWD` classes meet, their pairs are counted, and
   a pair goes on if the shared elements and what lies beyond the prefixes can reach the overlap
   needed.  So there are at most `CROWD` / 2 pairs for each prefix element.
4. Where more meet, no pairs are made.  Two sets that share only such crowded elements in their
   prefixes both hold one, so all sets that do meet again among themselves, in an order that has
   these elements last.  After `ROUNDS`, or when no new element is crowded (three quarters of a set
   are frequent ones), the classes that share one are put together without making pairs.
5. What goes on falls into blocks without links between them.  The sets of a block are joined in
   a prefix tree (see `trie`).  A block of many sets is dealt to slices: all slices hold the
   block's least set, so most sets are connected in the first round.  In the second, pairs of
   slices meet of which one holds sets outside the block's largest component, and whose sizes
   are near enough.

No pair is dropped: frequent elements only change the order, and bounds are exact.  Elements are
64-bit hashes.  Memory in a task is bounded by two slices of sets, a batch of text, the frequent
shingles (at most `MAX_FREQUENT` hashes) or a Bloom filter of rows (at most 2 bytes for each of
`SIEVE_ROWS`); these two, or `MAX_SENT` rows, are all that is sent to all tasks.  Texts are read
again, and of those only the ones that pass the filter are dealt out.

Edge cases: null and wordless texts have an empty set, link with nothing and are a component of
their own id; fewer than five words make one shingle; equal texts are linked; null ids are not
chosen as a component's id unless it has no other; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm import bloom
from titlelens.llm.common import stored
from titlelens.llm.components import components
from titlelens.llm.shingles import set_key, text_sets
from titlelens.llm.trie import connect

PERCENT = 75
# Frequent: in more than one of so many documents, or `CROWD` / 4, as far as tasks have seen.
FREQUENT_SHARE = 2000
MAX_FREQUENT = 1 << 19
CROWD = 64
ROUNDS = 4
COUNTED_AT_ONCE = 1 << 21
LEAST_LOCAL = 4
# A slice has at most so many sets, and of larger ones about so many elements.
SLICE = 2048
SLICE_ELEMENTS = 1 << 20
# A row of those that say which documents to read again is under 100 bytes.
MAX_SENT = 200_000
# A filter of more rows than so many lets more others pass.
SIEVE_ROWS = 1 << 24
SIEVE_PARTS = 64
MET = ["a", "b", "need", "gram"]


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and rows of the shingles that many of the task's sets have.

    Counts are over the sets read since the last emission, each distinct set once.
    """
    held, size, seen = [], 0, set()

    def counted() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= LEAST_LOCAL
        n = int(often.sum())
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, none, pa.nulls(n, pa.int64()), pa.array(values[often]),
             pa.array(counts[often].astype(np.int64))],
            names=["doc_id", "text_key", "n", "cls", "gram", "often"])

    for batch in batches:
        sizes, keys = [], []
        for values in text_sets(batch.column(2)):
            sizes.append(len(values))
            keys.append(set_key(values))
            if len(values) and keys[-1] not in seen:
                seen.add(keys[-1])
                held.append(values)
                size += len(values)
                if size >= COUNTED_AT_ONCE:
                    yield counted()
                    held, size, seen = [], 0, set()
        none = pa.nulls(len(sizes), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
             pa.array(keys, pa.int64()), none, none],
            names=["doc_id", "text_key", "n", "cls", "gram", "often"])
    if held:
        yield counted()


def _prefixes(frequent, percent: int):
    """Rows (gram, cls, n) of each set's prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = frequent.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            grams, classes, sizes = [], [], []
            for values in text_sets(batch.column(0)):
                n = len(values)
                if not n:
                    continue
                cls = set_key(values)
                if (cls, n) in seen:  # the task has sent this set
                    continue
                seen.add((cls, n))
                common = np.zeros(n, bool)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
                    common = hashes[at] == values
                p = prefix_length(n, percent)
                first = values[~common][:p]
                if len(first) < p:
                    late = values[common]
                    late = late[np.argsort(ranks[at[common]], kind="stable")][:p - len(first)]
                    first = np.concatenate([first, late])
                grams.append(first)
                classes.append(np.full(p, cls))
                sizes.append(np.full(p, n))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams)), pa.array(np.concatenate(classes)),
                     pa.array(np.concatenate(sizes).astype(np.int32))],
                    names=["gram", "cls", "n"])
    return run


def _meeting(percent: int):
    """From rows sorted by gram and class, the pairs of classes that meet at an element, smaller
    class first, with how many elements they need to meet at; and where more than `CROWD` meet,
    each class with the element."""
    def pairs(grams, classes, sizes) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        met = np.diff(first, append=len(grams))
        crowded = np.repeat(met > CROWD, met)
        if crowded.any():
            late = pa.array(classes[crowded])
            yield pa.RecordBatch.from_arrays(
                [late, late, pa.array(np.zeros(len(late), np.int32)),
                 pa.array(grams[crowded])], names=MET)
            grams, classes, sizes = (x[~crowded] for x in (grams, classes, sizes))
        beyond = sizes - prefix_length(sizes, percent)
        alive = np.flatnonzero(grams[1:] == grams[:-1])
        step = 1
        while len(alive):
            a, b = alive, alive + step
            na, nb = sizes[a], sizes[b]
            fits = (classes[a] != classes[b]) & (
                100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            a, b = a[fits], b[fits]
            if len(a):
                need = -(-percent * (sizes[a] + sizes[b]) // (100 + percent)) - np.maximum(
                    beyond[a], beyond[b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes[a]), pa.array(classes[b]), pa.array(need.astype(np.int32)),
                     pa.nulls(len(a), pa.int64())], names=MET)
            step += 1
            alive = alive[alive + step < len(grams)]
            alive = alive[grams[alive + step] == grams[alive]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                   for i in range(3)]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            # A class that several tasks have sent is there several times, side by side.
            once = np.ones(len(now[0]), bool)
            once[1:] = (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])
            now = [x[once] for x in now]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if cut:
                yield from pairs(*[x[:cut] for x in now])
            rest = [x[cut:] for x in now]
        if rest is not None and len(rest[0]):
            yield from pairs(*rest)
    return run


def _block_links(percent: int):
    """From texts sorted by block and slice, links between the sets within each slice."""
    def links(rows: list[tuple]) -> pa.RecordBatch:
        classes = [r[0] for r in rows]
        found = connect([r[1] for r in rows], [r[2] for r in rows], percent) \
            if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([classes[i] for i, _ in found], pa.int64()),
             pa.array([classes[j] for _, j in found], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            block, part, cls, label = (batch.column(i).to_pylist() for i in range(4))
            for i, values in enumerate(text_sets(batch.column(4))):
                if set_key(values) != cls[i]:
                    continue
                at = block[i], part[i]
                if at != key and rows:
                    yield links(rows)
                    rows = []
                key = at
                rows.append((cls[i], values, label[i]))
        if rows:
            yield links(rows)
    return run


def _row_key(doc_id: str | Column, text_key: str | Column) -> Column:
    return F.xxhash64(doc_id, text_key)


def _sieve(keys: DataFrame, count: int):
    """A function of a column that tells which values may be among `keys` (key): all that are,
    and few others.  count: of the rows of `keys`."""
    size = min(count, SIEVE_ROWS) // SIEVE_PARTS * 9 // 8 + SIEVE_PARTS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            hashed = batch.column(1).to_numpy().view(np.uint64)
            parts = batch.column(0).to_numpy()
            for part in np.unique(parts).tolist():
                bloom.add(held.setdefault(part, bloom.empty(size)), hashed[parts == part])
        for part, bits in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([bits.tobytes()])], names=["part", "bits"])

    # As `bloom.slice_of` has it.
    part = F.shiftrightunsigned("key", 40) % SIEVE_PARTS
    rows = (keys.select(part.alias("part"), "key").repartition("part")
            .mapInArrow(build, "part long, bits binary").collect())
    sent = keys.sparkSession.sparkContext.broadcast(
        {r["part"]: np.frombuffer(r["bits"], np.uint32) for r in rows})

    @F.pandas_udf("boolean")
    def may_be(key: pd.Series) -> pd.Series:
        hashed = key.to_numpy().view(np.uint64)
        parts, out = bloom.slice_of(hashed, SIEVE_PARTS), np.zeros(len(key), bool)
        for part, bits in sent.value.items():
            mine = np.flatnonzero(parts == part)
            out[mine[bloom.probe(bits, hashed[mine])]] = True
        return pd.Series(out)

    return may_be


class Scan:
    """The corpus as one narrow row per document, one document per class, and its frequent
    shingles."""

    def __init__(self, docs: DataFrame):
        rows = stored(
            docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.xxhash64("text").alias("text_key"), "text")
            .mapInArrow(_scan, "doc_id long, text_key long, n long, cls long, gram long, "
                               "often long"), "shingle-scan")
        self.docs = rows.filter("n is not null").select("doc_id", "text_key", "n", "cls")
        n = self.docs.count()
        self.often = (rows.filter("n is null").groupBy("gram").agg(F.sum("often").alias("often"))
                      .filter(F.col("often") > min(n / FREQUENT_SHARE, CROWD / 4))
                      .orderBy(F.desc("often"), "gram").limit(MAX_FREQUENT).toPandas())
        self.one = stored(self.docs.filter("n > 0").groupBy("cls").agg(
            F.min(F.struct("doc_id", "text_key")).alias("d"), F.max("n").alias("n")).select(
            "cls", "d.*", "n"), "classes")


def _late(often: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles, sorted, and their places in the order: the more frequent, the
    later.  often: (gram, often), the most frequent first."""
    hashes = often["gram"].to_numpy(np.int64)
    order = np.argsort(hashes)
    return hashes[order], (len(hashes) - np.arange(len(hashes)))[order]


def _met(docs: DataFrame, often: pd.DataFrame, percent: int) -> DataFrame:
    """(a, b, gram): pairs of classes that may be similar, and where more than `CROWD` meet in
    place of pairs each class, twice, with the element."""
    sent = docs.sparkSession.sparkContext.broadcast(_late(often))
    found = docs.select("text").mapInArrow(_prefixes(sent, percent), "gram long, cls long, n int")
    rows = found.repartition("gram").sortWithinPartitions("gram", "cls")
    meeting = rows.mapInArrow(_meeting(percent), "a long, b long, need int, gram long")
    return stored(meeting.groupBy(*MET).agg(F.count("*").alias("shared"))
                  .filter("gram is not null or shared >= need").select("a", "b", "gram"), "meeting")


def _candidates(docs: DataFrame, scan: Scan, percent: int) -> DataFrame:
    """(a, b): classes that may be similar, connected at least as all similar ones are."""
    often, texts, pairs = scan.often, docs, None
    for left in reversed(range(ROUNDS)):
        met = _met(texts, often, percent)
        found = met.filter("gram is null").select("a", "b")
        pairs = found if pairs is None else pairs.union(found)
        crowded = met.filter("gram is not null").select("a", "gram")
        counts = (crowded.groupBy("gram").agg(F.count("*").alias("often"))
                  .orderBy(F.desc("often"), "gram").limit(MAX_FREQUENT).toPandas())
        new = counts[~counts["gram"].isin(often["gram"])]
        if not left or new.empty:
            break
        often = pd.concat([often, new]).sort_values(
            ["often", "gram"], ascending=[False, True]).head(MAX_FREQUENT)
        keys = stored(crowded.select(F.col("a").alias("cls")).distinct().join(scan.one, "cls")
                      .select(_row_key("doc_id", "text_key").alias("key")), "crowded")
        among = _sieve(keys, keys.count())
        texts = docs.filter(among(_row_key(F.col("doc_id").cast("bigint"), F.xxhash64("text"))))
    low = crowded.groupBy("gram").agg(F.min("a").alias("low"))
    stars = crowded.join(low, "gram").select("a", F.col("low").alias("b"))
    return pairs.union(stars.filter("a != b").distinct())


def _texts(docs: DataFrame, members: DataFrame, count: int) -> DataFrame:
    """(block, slice, cls, label, text): the texts of the classes in `members`, read again."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("key"),
                        F.xxhash64("text").alias("key2"), "text")
    if count <= MAX_SENT:
        members = F.broadcast(members)
    else:
        among = _sieve(members.select(_row_key("doc_id", "text_key").alias("key")), count)
        texts = texts.filter(among(_row_key("key", "key2")))
    return (texts.join(members, F.col("key").eqNullSafe(F.col("doc_id"))
                       & (F.col("key2") == F.col("text_key")))
            .select("block", "slice", "cls", "label", "text"))


def _joined(texts: DataFrame, percent: int) -> DataFrame:
    return (texts.repartition("block", "slice").sortWithinPartitions("block", "slice", "cls")
            .mapInArrow(_block_links(percent), "a long, b long"))


def _slices() -> Column:
    """How many slices a group of sets takes."""
    return F.ceil(F.greatest(F.count("*") / SLICE, F.sum("n") / SLICE_ELEMENTS)).cast("int")


def _second_round(named: DataFrame, percent: int) -> DataFrame:
    """`named` with a slice for each meeting a set takes part in.

    The sets of a block are put in pieces of about `SLICE` by size band, and apart by whether
    they are in the block's largest component, which needs no more links inside.  Similar sets
    are of the same band or of neighbouring ones.
    """
    main = (named.groupBy("block", "label").count().groupBy("block")
            .agg(F.max(F.struct("count", "label"))["label"].alias("main")))
    width = math.log(100 / percent) * 1.001 if percent < 100 else 1.0
    rows = named.join(main, "block").withColumn("main", F.col("label") == F.col("main")).withColumn(
        "band", F.floor(F.log("n") / width).cast("int"))
    parts = rows.groupBy("block", "main", "band").agg(_slices().alias("parts"))
    rows = rows.join(parts, ["block", "main", "band"]).withColumn(
        "piece", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    spread = parts.select("block", "main", "band", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("piece"))
    pieces = stored(spread.select("block", F.struct("main", "band", "piece").alias("a")), "pieces")
    near = pieces.select("block", F.col("a").alias("b"), F.explode(F.array(
        *[F.col("a.band") + i for i in (-1, 0, 1)])).alias("band"))
    pairs = (pieces.withColumn("band", F.col("a.band")).join(near, ["block", "band"])
             .filter("a <= b and not (a.main and b.main)"))
    met = pairs.select("block", F.xxhash64("a", "b").alias("slice"), F.explode(
        F.array_distinct(F.array("a", "b"))).alias("p")).select("block", "slice", "p.*")
    return rows.join(met, ["block", "main", "band", "piece"]).select(
        "block", "slice", "cls", "label", "doc_id", "text_key")


def links(docs: DataFrame, scan: Scan, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between classes, enough to connect all that are similar."""
    blocks = stored(components(_candidates(docs, scan, percent)).select(
        F.col("node").alias("cls"), F.col("label").alias("block")), "blocks")
    sized = blocks.join(scan.one, "cls")
    sizes = sized.groupBy("block").agg(_slices().alias("slices"))
    members = sized.join(sizes, "block").select(
        "block", "cls", "doc_id", "text_key", "n", "slices")
    own = F.pmod(F.xxhash64("cls"), F.col("slices")).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("slices") - 1)
    members = stored(members.withColumn("own", own), "members")
    dealt = members.withColumn("slice", F.explode(
        F.when(F.col("cls") == F.col("block"), everywhere).otherwise(F.array("own")))).select(
        "block", F.col("slice").cast("long").alias("slice"), "cls",
        F.col("cls").alias("label"), "doc_id", "text_key")
    found = stored(_joined(_texts(docs, dealt, members.count()), percent), "trie-links")
    large = members.filter("slices > 1")
    if large.isEmpty():
        return found
    label = components(found.join(large.select(F.col("cls").alias("a")), "a").select("a", "b"))
    named = stored(large.join(label.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls")), "named")
    again = stored(_second_round(named, percent), "again")
    more = stored(_joined(_texts(docs, again, again.count()), percent), "trie-links")
    return found.union(more)


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_key, n, group, component for each row of `docs`.

    group: the class that stands for all similar ones, whatever ids their texts have.
    """
    scan = Scan(docs)
    label = components(links(docs, scan, percent))
    classes = (scan.docs.filter("n > 0").groupBy("cls")
               .agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
               .join(label.withColumnRenamed("node", "cls"), "cls", "left")
               .filter("copies > 1 or label is not null")
               .withColumn("label", F.coalesce("label", "cls")))
    least = classes.groupBy("label").agg(F.min("least").alias("component"))
    named = classes.join(least, "label").select("cls", "label", "component")
    return scan.docs.join(named, "cls", "left").select(
        "doc_id", "text_key", "n", F.coalesce("label", "cls").alias("group"), "component")


def similar(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id for each row of `docs`."""
    return _grouped(docs, percent).select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "doc_id"))
        .otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` with one row of each group of similar texts: the least id's.  Texts without words
    all stay.  Unlike texts all stay too, be their ids null or shared."""
    rows = stored(_grouped(docs, percent).filter("n > 0").groupBy("group", "doc_id", "text_key")
                  .agg(F.count("*").alias("rows")), "worded")
    kept = rows.groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("d")).select(
        F.col("d.doc_id").alias("kept_id"), F.col("d.text_key").alias("kept_key"))
    # What goes, and what stays in one of several equal rows.
    odd = stored(rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id"))
                           & (F.col("text_key") == F.col("kept_key")), "left")
                 .withColumn("one", F.col("kept_key").isNotNull()).filter("not one or rows > 1")
                 .select(F.col("doc_id").alias("odd_id"), F.col("text_key").alias("odd_key"), "one"),
                 "odd")
    # The columns in one struct, so that no name of theirs can clash with one added here.
    named = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        docs["doc_id"].cast("bigint").alias("id"),
                        F.xxhash64(docs["text"]).alias("key"))
    same = F.col("id").eqNullSafe(F.col("odd_id")) & (F.col("key") == F.col("odd_key"))
    count = odd.count()
    if count <= MAX_SENT:
        looked = named.join(F.broadcast(odd), same, "left")
        left = looked.filter("one is null").select("row")
    else:
        among = _sieve(odd.select(_row_key("odd_id", "odd_key").alias("key")), count)
        named = named.withColumn("odd", among(_row_key("id", "key")))
        looked = named.filter("odd").join(odd, same, "left")
        left = named.filter("not odd").select("row").union(
            looked.filter("one is null").select("row"))
    if not odd.filter("one").isEmpty():
        left = left.union(looked.filter("one").withColumn("same", F.xxhash64("id", "key"))
                          .dropDuplicates(["same"]).select("row"))
    return left.select("row.*")
