"""Benchmark decontamination: a hash set of the test items' word windows, scanned over all text.

Windows are `window` consecutive words (A-Z lowered, punctuation ignored); an item of fewer
words is one window.  The hashes of all windows go to every task as a set, a document's windows
are looked up in it inside the row, and those found are compared with the items' windows word by
word.  A document word inside any occurrence is hit.

The set is bounded.  Up to `MAX_SET` hashes are looked up inside the row.  Of more, up to
`MAX_SENT` are sent along as a table, and each row's hashes are joined with it where they are; the
words of the hits are then looked at again.  A still larger benchmark meets the hashes by shuffle.
The results are equal.

Edge cases: null or wordless texts have no windows and no hits; items without words match
nothing; an item repeated, or a window that several items share, counts each item once; items
with a null id give hits but are not listed; each row of a repeated document gets its own result;
empty tables give no rows or no hits.  Further columns of either table are not looked at.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small
from titlelens.llm.common import gram_hash, gram_text, grams, stored, words

WINDOW = 10
MAX_SET = 20_000
MAX_SENT = 2_000_000


class BenchmarkWindows:
    """The windows of a benchmark, stored as (gram, item_id), and what is sent along of them."""

    def __init__(self, benchmark: DataFrame, window: int = WINDOW):
        items = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                                 words(F.col("text")).alias("w"))
        width = F.least(F.size("w"), F.lit(window))
        starts = F.when(width > 0, F.sequence(F.lit(0), F.size("w") - width))
        self.table = stored(
            items.select("item_id", "w", width.alias("n"), F.explode(starts).alias("i"))
            .select("item_id", "n", F.array_join(F.slice("w", F.col("i") + 1, F.col("n")), " ")
                    .alias("gram")).distinct(), "windows")
        self.grams = self.table.select("gram", "n").distinct()
        self.count = self.grams.count()
        # At most `window` lengths.
        self.lengths = sorted(r["n"] for r in self.grams.select("n").distinct().collect())
        self.texts: dict[int, list[str]] | None = None
        if self.count <= MAX_SET:
            self.texts = {n: [] for n in self.lengths}
            for row in self.grams.collect():
                self.texts[row["n"]].append(row["gram"])

    def hashes(self, n: int) -> list[int] | None:
        if self.texts is None:
            return None
        split = self.grams.filter(F.col("n") == n).select(F.split("gram", " ").alias("w"))
        return [r[0] for r in split.select(gram_hash(F.col("w"), F.lit(0), n)).collect()]


def _hits(array: Column, bench: BenchmarkWindows) -> Column:
    """All windows of the array that may be one of the benchmark's."""
    found = [grams(array, n, bench.hashes(n)) for n in bench.lengths]
    return F.concat(*found) if found else F.array().cast(
        "array<struct<pos:int,n:int,gram:string>>")


def _scanned(docs: DataFrame, bench: BenchmarkWindows) -> DataFrame:
    """doc_id, text_key, n_words, hits, rows: each distinct id and text once; stored.

    Rows alike are put together in each task before they are shuffled.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                       words(F.col("text")).alias("w"))
    counts = [F.max("n_words").alias("n_words"), F.count("*").cast("int").alias("rows")]
    size = F.size("w").cast("bigint").alias("n_words")
    if bench.texts is not None or not bench.lengths:
        found = rows.select("doc_id", "text_key", size, _hits(F.col("w"), bench).alias("hits"))
        return stored(found.groupBy("doc_id", "text_key").agg(
            F.first("hits").alias("hits"), *counts), "window-hits")
    split = bench.grams.select("n", F.split("gram", " ").alias("k"))
    known = reduce(DataFrame.union, [
        split.filter(F.col("n") == n).select("n", gram_hash(F.col("k"), F.lit(0), n).alias("hash"))
        for n in bench.lengths]).distinct()
    known = F.broadcast(known) if bench.count <= MAX_SENT else known

    def windows(n: int) -> Column:
        starts = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(
            i.alias("pos"), F.lit(n).alias("n"), gram_hash(F.col("w"), i, n).alias("hash")))

    spread = rows.select("doc_id", "text_key", F.explode(F.concat(*[
        windows(n) for n in bench.lengths])).alias("h")).select("doc_id", "text_key", "h.*")
    met = (spread.join(known, ["n", "hash"]).groupBy("doc_id", "text_key")
           .agg(F.collect_set(F.struct("pos", "n")).alias("places")))
    met = stored(met.withColumnsRenamed({"doc_id": "met_id", "text_key": "met_key"}), "window-met")
    here = rows["doc_id"].eqNullSafe(met["met_id"]) & (rows["text_key"] == met["met_key"])
    some = rows.join(met, here).select("doc_id", "text_key", F.transform(
        "places", lambda p: F.struct(p["pos"].alias("pos"), p["n"].alias("n"), F.array_join(
            F.slice("w", p["pos"] + 1, p["n"]), " ").alias("gram"))).alias("hits"))
    some = some.groupBy("doc_id", "text_key").agg(F.first("hits").alias("hits"))
    every = rows.select("doc_id", "text_key", size).groupBy("doc_id", "text_key").agg(*counts)
    some = some.withColumnsRenamed({"doc_id": "met_id", "text_key": "met_key"})
    return stored(every.join(some, every["doc_id"].eqNullSafe(some["met_id"]) & (
        every["text_key"] == some["met_key"]), "left").select(
        "doc_id", "text_key", F.coalesce("hits", F.array().cast(
            "array<struct<pos:int,n:int,gram:string>>")).alias("hits"), "n_words", "rows"),
        "window-hits")


def _per_text(docs: DataFrame, bench: BenchmarkWindows) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, rows, items for each distinct id and text of `docs`."""
    scanned = _scanned(docs, bench)
    spread = scanned.select("doc_id", "text_key", F.explode("hits").alias("h")).select(
        "doc_id", "text_key", "h.*")
    items = bench.table.groupBy("gram").agg(F.collect_set("item_id").alias("items"))
    found = spread.join(broadcast_if_small(items, bench.count), "gram")
    one = Window.partitionBy("doc_id", "text_key")
    before = one.orderBy("pos", "n").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.coalesce(F.max(F.col("pos") + F.col("n")).over(before), F.lit(0)),
                       F.col("pos"))
    fresh = F.greatest(F.col("pos") + F.col("n") - reach, F.lit(0))
    hit = found.select("doc_id", "text_key", fresh.alias("fresh"), "items")
    none = F.lit(None)
    # Texts without hits come in only after the join, so no key holds them all.
    both = hit.withColumns({"n_words": none.cast("bigint"), "rows": none.cast("int")}).unionByName(
        scanned.select("doc_id", "text_key", F.lit(0).alias("fresh"),
                       none.cast("array<string>").alias("items"), "n_words", "rows"))
    return both.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.sum("fresh").cast("bigint").alias("n_hit"),
        F.max("rows").alias("rows"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; one row per row of `docs`."""
    return _per_text(docs, BenchmarkWindows(benchmark, window)).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows"))).alias("copy")).drop("copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` in which no window of the benchmark occurs, with all their columns.

    While the windows fit the set, texts are judged where they are read, without a shuffle.
    """
    bench = BenchmarkWindows(benchmark, window)
    if not bench.lengths:
        return docs
    if bench.texts is None:
        dirty = _per_text(docs, bench).filter("n_hit > 0").select(
            F.col("doc_id").alias("__doc_id"), F.col("text_key").alias("__text_key"))
        return docs.join(dirty, docs["doc_id"].eqNullSafe(dirty["__doc_id"])
                         & (F.xxhash64(docs["text"]) == dirty["__text_key"]), "left_anti")

    def known(array: Column, n: int) -> Column:
        hashes, texts = bench.hashes(n), bench.texts[n]
        starts = F.when(F.size(array) >= n, F.sequence(F.lit(0), F.size(array) - n))
        return F.coalesce(F.exists(starts, lambda i: gram_hash(array, i, n).isin(hashes)
                                   & gram_text(array, i, n).isin(texts)), F.lit(False))

    # The words are the argument of a function, so that they are made once for each text, where
    # the filter would otherwise make them anew for every place.
    dirty = F.exists(F.array(words(docs["text"])),
                     lambda array: reduce(or_, [known(array, n) for n in bench.lengths]))
    return docs.filter(~dirty)
