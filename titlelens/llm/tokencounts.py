"""Token counts of whole texts, with huge texts encoded in parallel pieces.

A text of more than `CHUNK` characters is cut into chunks that overlap their neighbours by
`OVERLAP` characters.  Each chunk is encoded by itself, with the offsets of its tokens, and two
neighbours are spliced where the overlap holds the same two consecutive tokens at the same places
in both.  That splice is exact for byte-pair merging.  Merges go by score and then from the left,
so what happens on one side of a boundary that no merge crosses does not depend on the other side:
a text with a token boundary at p has the tokens of what is before p, then of what is after p.
And if two tokens that touch at p stay apart when only those two are encoded, no merge crosses p
in any longer text in which both sides came to these tokens: the first merge to cross would be
the best at hand between the two tokens alone as well.  Where two neighbours agree in no pair,
the text is cut anew with chunks and overlaps `WIDER` times as long, in the end as one chunk.

What is spliced are numbers: a junction takes off the tokens of the left chunk after the boundary
and those of the right one before it, and the rest is a sum by text.  So no task sees more than a
chunk, however long a text is, unless its chunks never agree.

Equal huge texts are encoded once.  Models other than byte-pair ones with an identity normalizer
have no such proof: all texts are then encoded whole.

Edge cases: a null text is an empty one, with no tokens; repeated rows and null ids are each
returned; an empty table gives no rows; of extra columns none is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_proto

from titlelens.llm.common import stored

CHUNK = 1 << 14
OVERLAP = 1 << 9
WIDER = 4
TOKEN_LIMIT = 4096
BATCH_CHARS = 1 << 20

# Kinds of pieces and models in the model's own format.
_BYTE_PAIR, _PLAIN, _UNKNOWN, _CONTROL, _BYTE = 2, 1, 2, 3, 6

_models: dict[str, sentencepiece.SentencePieceProcessor] = {}


def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    """One per worker process."""
    if path not in _models:
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def can_splice(path: str) -> bool:
    """Whether the model merges byte pairs over text that it leaves as it is."""
    told = model_proto.ModelProto()
    with open(path, "rb") as file:
        told.ParseFromString(file.read())
    normal = told.normalizer_spec
    return (told.trainer_spec.model_type == _BYTE_PAIR and not normal.precompiled_charsmap
            and not normal.remove_extra_whitespaces and normal.escape_whitespaces
            and normal.add_dummy_prefix and told.trainer_spec.byte_fallback
            and not told.trainer_spec.treat_whitespace_as_suffix
            and {p.type for p in told.pieces} <= {_PLAIN, _UNKNOWN, _CONTROL, _BYTE})


class _Offsets:
    """How many characters each token covers.  The first byte of a character that has no piece
    covers it, its other bytes nothing."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        self.size = size
        self.width = np.array([len(p) for p in pieces], np.int64)
        self.opens = np.ones(size, bool)
        for i in range(size):
            if model.is_byte(i):
                self.opens[i] = int(pieces[i][3:-1], 16) & 0xC0 != 0x80
                self.width[i] = int(self.opens[i])

    def pairs(self, ids: np.ndarray, first: int, last: int, left: bool
              ) -> tuple[np.ndarray, np.ndarray]:
        """The consecutive tokens of which the first begins in [first, last): a number that says
        where (from `first`) and which they are, and the tokens on the side to be taken off."""
        # The model puts a space in front, so the text begins after one character.
        starts = np.cumsum(self.width[ids]) - self.width[ids] - 1
        at = np.flatnonzero(self.opens[ids])
        begin, end = np.searchsorted(starts[at], [first, last])
        end = min(int(end), len(at) - 1)
        one, two = at[begin:end], at[begin + 1:end + 1]
        keys = ((starts[one] - first) * self.size + ids[one]) * self.size + ids[two]
        return keys, len(ids) - two if left else two


_offsets: dict[str, _Offsets] = {}


def _offsets_of(path: str) -> _Offsets:
    if path not in _offsets:
        _offsets[path] = _Offsets(_model(path))
    return _offsets[path]


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """A few texts at a time, however long they are."""
    held, chars = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        chars += len(held[-1])
        if chars >= BATCH_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _whole(rows: DataFrame, model: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of texts that are encoded in one go."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(ids) for texts in _groups(batch.column(2))
                      for ids in _model(model).encode(texts, num_threads=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    return rows.select("doc_id", "n_bytes", "text").mapInArrow(
        count, rows.select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_tokens")).schema)


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """text_key, place, last, piece: the overlapping chunks, one row each however many copies of
    a text there are.  Few texts at a time are in a plain function, which cuts each in time of
    its length; Arrow would bring thousands of huge ones at once."""
    step = chunk - overlap

    def cut(text: str) -> list[str]:
        n = max(1, -(-(len(text) - overlap) // step))
        return [text[place * step:place * step + chunk] for place in range(n)]

    pieces = texts.select("text_key", F.udf(cut, "array<string>", useArrow=False)("text").alias(
        "pieces"))
    cuts = pieces.select("text_key", F.size("pieces").alias("n"),
                         F.posexplode("pieces").alias("place", "piece"))
    return cuts.groupBy("text_key", "place").agg(
        F.first(F.col("place") == F.col("n") - 1).alias("last"), F.first("piece").alias("piece"))


def _encoded(chunks: DataFrame, model: str, chunk: int, overlap: int) -> DataFrame:
    """text_key, place, last, n, and the pairs in the overlaps with what goes if one is taken."""
    listed = pa.list_(pa.int64())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = _offsets_of(model)
        for batch in batches:
            n, head, tail = [], [], []
            for texts in _groups(batch.column(3)):
                for ids in _model(model).encode(texts, num_threads=1):
                    ids = np.array(ids, np.int64)
                    n.append(len(ids))
                    head.append(offsets.pairs(ids, 0, overlap, left=False))
                    tail.append(offsets.pairs(ids, chunk - overlap, chunk, left=True))
            pairs = [pa.array([side[k] for side in sides], listed)
                     for sides in (head, tail) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), *pairs],
                names=["text_key", "place", "last", "n", "head", "head_off", "tail", "tail_off"])

    return chunks.mapInArrow(encode, (
        "text_key string, place int, last boolean, n long, head array<long>, "
        "head_off array<long>, tail array<long>, tail_off array<long>"))


def _spliced(encoded: DataFrame) -> DataFrame:
    """text_key, n_tokens: null where a junction of the text has no pair in common."""
    left = encoded.filter("not last").select("text_key", "place", "tail", "tail_off")
    right = encoded.select("text_key", (F.col("place") - 1).alias("place"), "head", "head_off")
    common = F.array_intersect("tail", "head")
    # The pair in the middle has most text on both sides.
    pair = F.get(common, F.floor(F.size(common) / 2).cast("int"))

    def off(keys: str, counts: str) -> Column:
        return F.get(counts, F.array_position(keys, F.col("pair")).cast("int") - 1)

    taken = (left.join(right, ["text_key", "place"]).withColumn("pair", pair)
             .select("text_key", (-off("tail", "tail_off") - off("head", "head_off")).alias("n")))
    return (encoded.select("text_key", "n").unionByName(taken).groupBy("text_key")
            .agg(F.when(F.count("*") == F.count("n"), F.sum("n")).alias("n_tokens")))


def _huge(texts: DataFrame, model: str, chunk: int, overlap: int) -> DataFrame:
    """text_key, n_tokens of texts of any length, each key once."""
    done = None
    while True:
        encoded = stored(_encoded(_chunks(texts, chunk, overlap), model, chunk, overlap), "chunks")
        found = stored(_spliced(encoded), "spliced")
        settled = found.filter("n_tokens is not null")
        done = settled if done is None else done.unionByName(settled)
        open_keys = found.filter("n_tokens is null").select("text_key")
        if open_keys.isEmpty():
            return done
        # Both sides are huge texts only; a key is there once on the right.
        texts = texts.join(open_keys, "text_key", "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER


def count_tokens(docs: DataFrame, model: str, limit: int = TOKEN_LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.  `model` is the path of a vocabulary.

    `chunk` must be more than twice `overlap`, so that two cuts of a chunk are in order.
    """
    if chunk <= 2 * overlap:
        raise ValueError("a chunk must be longer than two overlaps")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    if can_splice(model):
        short = rows.filter(F.length("text") <= chunk)
        # Bytes bound characters, so most rows are settled without a look at the text.
        long = rows.filter((F.col("n_bytes") > chunk) & (F.length("text") > chunk)).withColumn(
            "text_key", F.sha2("text", 256))
        counts = _huge(long, model, chunk, overlap)
        found = (long.select("doc_id", "n_bytes", "text_key").join(counts, "text_key")
                 .select("doc_id", "n_bytes", "n_tokens"))
        counted = _whole(short, model).unionByName(found)
    else:
        counted = _whole(rows, model)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
