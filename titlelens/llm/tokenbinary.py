"""Token-ID output: whole texts as token ids in compressed blocks, in ascending order of doc_id.

The file format is a Parquet table with one row per shard, of about `SHARD_TOKENS` ids:

* `part`, `shard`: place in the order; `table`: the frequency table all blocks of the shard share;
* `doc_ids`, `lengths`: its documents in order and their ids, the end id included;
* `blocks`: independent blocks of `BLOCK_TOKENS` ids (see `rans`), each with interleaved states,
  checkpoints and a checksum.

A document is never split over shards, but may span blocks.  A shard is written by one task from
a stream of documents, so memory is bounded by a shard and the longest text.

Edge cases: a null text is an empty one, that is the end id alone; null ids come first; rows of
equal id are ordered by a hash of the text, and each is kept; an empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small
from titlelens.llm import rans
from titlelens.llm.tokenize import MEMO_BYTES, encoder

SHARD_TOKENS = 1 << 22
BLOCK_TOKENS = 1 << 19
END_ID = 2
BATCH_CHARS = 1 << 21

BLOCK = pa.struct([("n_tokens", pa.int32()), ("lanes", pa.int32()),
                   ("offsets", pa.list_(pa.int32())), ("states", pa.binary()),
                   ("payload", pa.binary()), ("crc32", pa.int64())])
SHARD = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()),
                   ("table", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                   ("lengths", pa.list_(pa.int64())), ("blocks", pa.list_(BLOCK))])
SHARD_DDL = ("part int, shard int, n_tokens long, table binary, doc_ids array<long>, "
             "lengths array<long>, blocks array<struct<n_tokens:int, lanes:int, "
             "offsets:array<int>, states:binary, payload:binary, crc32:long>>")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """A few documents at a time, however long the batch's texts are."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or ""
            ids.append(doc_id.as_py())
            texts.append(text)
            held += len(text)
            if held >= BATCH_CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _shard(part: int, shard: int, doc_ids: list, encoded: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(encoded), "<u4")
    table = rans.Table.of(ids)
    blocks = [rans.encode(ids[at:at + BLOCK_TOKENS], table)
              for at in range(0, len(ids), BLOCK_TOKENS)]
    row = {"part": part, "shard": shard, "n_tokens": len(ids), "table": table.to_bytes(),
           "doc_ids": doc_ids, "lengths": [len(e) // 4 for e in encoded], "blocks": blocks}
    return pa.RecordBatch.from_pylist([row], schema=SHARD)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                 memo_bytes: int = MEMO_BYTES) -> None:
    """Write the ids of all texts to `path`.  `tokenizer` is the path of a vocabulary file.

    A worker keeps the ids of words in two halves of `memo_bytes`: fewer where it shares its
    memory with other stages, for some more time.
    """
    end = np.array([end_id], "<u4").tobytes()

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        doc_ids, encoded, held = [], [], 0
        for ids, texts in _pieces(batches):
            for doc_id, data in zip(ids, encoder(tokenizer, memo_bytes).encode(texts)):
                doc_ids.append(doc_id)
                encoded.append(data + end)
                held += len(data) // 4 + 1
                if held >= SHARD_TOKENS:
                    yield _shard(part, shard, doc_ids, encoded)
                    doc_ids, encoded, held, shard = [], [], 0, shard + 1
        if doc_ids:
            yield _shard(part, shard, doc_ids, encoded)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64("text").alias("tie"))
    (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .select("doc_id", "text").mapInArrow(to_shards, SHARD_DDL)
     .write.option("compression", "uncompressed").parquet(path))


def _starts(shards: DataFrame) -> DataFrame:
    """part, shard, first: the ids before each shard.  Counts by part come first, so that the
    window over everything sees one row per part."""
    held = shards.select("part", "shard", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = (held.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .withColumn("base", F.coalesce(F.sum("n").over(
                 before.orderBy("part")), F.lit(0))).drop("n"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    return (held.join(parts, "part").select("part", "shard", (
        F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("first")))


def _decoded(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            table = rans.Table.from_bytes(row["table"])
            slots = table.slots()
            ids = np.concatenate([rans.decode(b, table, slots) for b in row["blocks"]])
            ends = np.cumsum(np.array(row["lengths"], np.int64))
            starts = ends - np.array(row["lengths"], np.int64)
            n = len(ends)
            columns = [pa.array(row["doc_ids"], pa.int64()),
                       pa.array(row["first"] + starts, pa.int64()),
                       pa.array(ends - starts, pa.int64()),
                       pa.array([zlib.crc32(ids[a:b].astype("<u4").tobytes())
                                 for a, b in zip(starts, ends)], pa.int64()),
                       pa.array([row["part"]] * n, pa.int32()),
                       pa.array([row["shard"]] * n, pa.int32())]
            names = ["doc_id", "start", "n_tokens", "ids_crc32", "part", "shard"]
            if with_ids:
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, ids.astype(np.int32)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, part, shard (and ids), decoded from the files."""
    shards = spark.read.schema(SHARD_DDL).parquet(path)
    starts = _starts(shards)
    rows = shards.count()
    placed = shards.join(broadcast_if_small(starts, rows), ["part", "shard"])
    ddl = ("doc_id long, start long, n_tokens long, ids_crc32 long, part int, shard int"
           + (", ids array<int>" if with_ids else ""))
    return placed.mapInArrow(lambda batches: _decoded(batches, with_ids), ddl)
