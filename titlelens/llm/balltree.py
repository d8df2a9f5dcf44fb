"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Vectors become whole numbers, floor(scale * x), are numbered and dealt to shards.  Each shard is
one row holding its tree.  Queries go in blocks.  First each block searches one shard; the k-th
score found there is shared with the searches of all other shards, which leave every node whose
upper bound is below it.  Within a search, nodes are taken by falling upper bound, and the k-th
score rises as vectors are found.  The bound is a node's |q| * radius + q . centre; scores are
exact whole numbers.

Memory in a task is bounded by a shard and a block, whatever the data.

Edge cases: a vector that is null or holds a null or non-finite component takes no part; vectors
of different length are not compared; a query is compared with every row but its own, so a
repeated row is found by its copy; equal scores go to the smaller vec_id, rows without one last;
fewer rows than k give fewer; empty tables give no rows.  Scores beyond 64 bits are clamped.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small
from titlelens.llm.common import stored

SHARD_ROWS = 4096
BLOCK_ROWS = 512
LEAF_ROWS = 64
SCALE = 1024
_LARGEST = (1 << 63) - 1


def _matrix(column) -> np.ndarray:
    values = column.values.to_numpy(zero_copy_only=False) if isinstance(
        column, pa.ListArray) else column
    return values.reshape(len(column), -1)


class Tree:
    """Rows permuted so that every node is a range; children follow their parents."""

    def __init__(self, rows: np.ndarray):
        n = len(rows)
        self.order = np.arange(n)
        as_float = rows.astype(np.float64)
        nodes, work = [], [(0, n, -1)]
        while work:
            lo, hi, parent = work.pop()
            place = len(nodes)
            part = as_float[self.order[lo:hi]]
            centre = part.mean(axis=0) if rows.shape[1] else np.zeros(0)
            radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            nodes.append([lo, hi, -1, -1, centre, radius])
            if parent >= 0:
                nodes[parent][2 if nodes[parent][2] < 0 else 3] = place
            if hi - lo > LEAF_ROWS and radius > 0:
                spread = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                half = (hi - lo) // 2
                split = np.argpartition(part[:, spread], half)
                self.order[lo:hi] = self.order[lo:hi][split]
                work += [(lo + half, hi, place), (lo, lo + half, place)]
        self.spans = [(n[0], n[1]) for n in nodes]
        self.children = [(n[2], n[3]) for n in nodes]
        self.centres = np.array([n[4] for n in nodes]).reshape(len(nodes), rows.shape[1])
        self.radii = np.array([n[5] for n in nodes])
        self.rows = rows[self.order]


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray | list[int]:
    """Exact inner products: in doubles while all sums fit, in 64 bits, or in Python's ints."""
    if not len(query):
        return np.zeros(len(rows), np.int64)
    most = float(np.abs(rows.astype(np.float64)).max(initial=0)) * float(
        np.abs(query.astype(np.float64)).sum())
    if most < 2 ** 53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if most < 2 ** 62:
        return rows @ query
    exact = rows.astype(object) @ query.astype(object)
    return [max(-_LARGEST - 1, min(_LARGEST, int(s))) for s in exact]


def search(tree: Tree, numbers: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int,
           least: int | None) -> list[tuple[int, int, int]]:
    """The best (score, vec_id, number) of the tree for a query, none below `least`.

    own: the number of the query's row.  ids: null is the largest number.
    """
    length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
    bounds = tree.centres @ query.astype(np.float64) + length * tree.radii
    bounds = bounds + 1e-6 + 1e-9 * np.abs(bounds) + 1e-9 * length * (
        np.abs(tree.centres).max(initial=0) + tree.radii)
    best: list[tuple[int, int, int]] = []  # heap: the worst first; smaller ids are better
    work = [(-bounds[0], 0)]
    while work:
        bound, place = heapq.heappop(work)
        kth = best[0][0] if len(best) == k else least
        if kth is not None and -bound < kth:
            break
        left, right = tree.children[place]
        if left >= 0:
            heapq.heappush(work, (-bounds[left], left))
            heapq.heappush(work, (-bounds[right], right))
            continue
        lo, hi = tree.spans[place]
        scores = _scores(tree.rows[lo:hi], query)
        if kth is not None and not isinstance(scores, list):
            good = np.flatnonzero(scores >= kth)
        else:
            good = range(hi - lo)
        for i in good:
            if numbers[lo + i] == own:
                continue
            entry = (int(scores[i]), -int(ids[lo + i]), -int(numbers[lo + i]))
            if len(best) < k:
                if least is None or entry[0] >= least:
                    heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return [(s, -i, -n) for s, i, n in best]


def _whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def vectors(table: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """number, vec_id, shard, v: the rows that take part, numbered and dealt evenly; stored."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x.cast("double")) == float("inf")))
    rows = stored(table.filter(v.isNotNull()).filter(~odd).select(
        F.monotonically_increasing_id().alias("number"),
        F.col("vec_id").cast("bigint").alias("vec_id"), _whole(v, scale).alias("v")), "vectors")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    return rows.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)))


NONE = _LARGEST


def _grow(table: pa.Table) -> pa.Table:
    rows = _matrix(table["v"].combine_chunks())
    tree = Tree(rows)
    ids = table["vec_id"].fill_null(NONE).to_numpy()[tree.order]
    numbers = table["number"].to_numpy()[tree.order]
    spans = np.array([[*s, *c] for s, c in zip(tree.spans, tree.children)], np.int32)
    return pa.table({
        "shard": table["shard"][:1], "dim": pa.array([rows.shape[1]], pa.int32()),
        "n": pa.array([len(rows)], pa.int32()), "numbers": [numbers.astype("<i8").tobytes()],
        "ids": [ids.astype("<i8").tobytes()], "rows": [tree.rows.astype("<i8").tobytes()],
        "spans": [spans.tobytes()], "centres": [tree.centres.tobytes()],
        "radii": [tree.radii.tobytes()]})


TREE = ("shard long, dim int, n int, numbers binary, ids binary, rows binary, spans binary, "
        "centres binary, radii binary")


def _planted(row: dict) -> tuple[Tree, np.ndarray, np.ndarray]:
    tree = Tree.__new__(Tree)
    dim = row["dim"]
    spans = np.frombuffer(row["spans"], np.int32).reshape(-1, 4).tolist()
    tree.spans = [(s[0], s[1]) for s in spans]
    tree.children = [(s[2], s[3]) for s in spans]
    tree.centres = np.frombuffer(row["centres"]).reshape(len(spans), dim)
    tree.radii = np.frombuffer(row["radii"])
    tree.rows = np.frombuffer(row["rows"], "<i8").reshape(row["n"], dim)
    return tree, np.frombuffer(row["numbers"], "<i8"), np.frombuffer(row["ids"], "<i8")


def _search_all(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                tree, numbers, ids = _planted(row)
                out = []
                for q in row["queries"]:
                    for s, vec_id, number in search(
                            tree, numbers, ids, np.array(q["v"], np.int64), q["number"], k,
                            q["least"]):
                        out.append((q["number"], q["vec_id"],
                                    None if vec_id == NONE else vec_id, number, s))
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["query", "query_id", "vec_id", "number", "score"])
    return run


FOUND = "query long, query_id long, vec_id long, number long, score long"


def _searched(trees: DataFrame, count: int, blocks: DataFrame, k: int) -> DataFrame:
    """Every block of queries, which names the shard it goes to, in that shard's trees."""
    return (trees.join(blocks.withColumnRenamed("dim", "d").withColumnRenamed("shard", "s"),
                       (F.col("shard") == F.col("s")) & (F.col("dim") == F.col("d")))
            .drop("s", "d", "block").mapInArrow(_search_all(k), FOUND))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last(), "number")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(table: DataFrame, k: int = 10, every: int = 100, vector: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`."""
    rows = vectors(table, vector, scale)
    trees = stored(rows.groupBy("shard", F.size("v").alias("size")).applyInArrow(
        lambda key, t: _grow(t), TREE), "ball-trees")
    shards = trees.select("shard", "dim")
    count = shards.count()
    asked = rows.filter(F.col("vec_id") % every == 0).select(
        "number", "vec_id", "v", F.size("v").alias("dim"))
    n_blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(n_blocks)))
    # The shard a block begins with: of those with vectors of its length, by turns.
    turn = Window.partitionBy("dim").orderBy("shard")
    homes = shards.withColumn("turn", F.row_number().over(turn) - 1).withColumn(
        "turns", F.count("*").over(Window.partitionBy("dim")))

    def packed(queries: DataFrame, least: Column) -> DataFrame:
        return queries.groupBy("block", "dim").agg(F.collect_list(F.struct(
            "number", "vec_id", "v", least.alias("least"))).alias("queries"))

    near = broadcast_if_small(homes.withColumnRenamed("dim", "d"), count)
    begun = (packed(asked, F.lit(None).cast("bigint"))
             .join(near, (F.col("dim") == F.col("d"))
                   & (F.pmod("block", F.col("turns")) == F.col("turn"))).drop("d", "turn", "turns"))
    first = stored(_best(_searched(trees, count, begun, k), k), "first-shard")
    kth = first.groupBy("query").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    bounded = asked.join(kth.withColumnRenamed("query", "number"), "number", "left")
    others = (packed(bounded, F.when(F.col("n") >= k, F.col("low")))
              .join(near, (F.col("dim") == F.col("d"))
                    & (F.pmod("block", F.col("turns")) != F.col("turn")))
              .drop("d", "turn", "turns"))
    found = first.drop("rank").unionByName(_searched(trees, count, others, k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
