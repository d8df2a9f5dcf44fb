"""Token files: exact round trips, order, checksums, independent parts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from titlelens.llm import rans, tokenbinary
from titlelens.llm.queries import byte_bpe
from titlelens.llm.tokenize import Encoder
from titlelens.plans.scratch import scratch_path

LIBRARY = Tokenizer.from_file(byte_bpe())
ENCODER = Encoder(byte_bpe())


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a \n b", "\na", "a\n", "it's we'll I'M",
       "x<|endoftext|>y <|endoftext|> z", "tab\tx y", "é ü ß x 汉字 🙂", "1234 5,6 ... ---",
       "a\x1cb c", "line one.\nLine two. \nthree"]


@pytest.mark.parametrize("text", ODD)
def test_ids_are_the_librarys(text):
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == plain(text)


def test_memo_is_bounded_in_bytes():
    """Texts without spaces are encoded, but not kept; many words push older ones out."""
    from titlelens.llm import tokenize
    mine = Encoder(byte_bpe(), 20_000)
    texts = ["汉字" * 400 + str(i) for i in range(20)] + [
        " ".join(f"w{i}x{j}, abc{'defgh'[j % 5] * (j % 9)}." for j in range(60)) for i in range(20)]
    for text in texts + texts[::-1]:
        assert np.frombuffer(mine.encode([text])[0], "<u4").tolist() == plain(text)
        assert all(len(w) <= tokenize.LONG_WORD for w in mine.memo)
        assert len(mine.memo) + len(mine.memo.older) < 400


def test_each_distinct_word_is_looked_up_once(monkeypatch):
    from titlelens.llm import tokenize

    class Counted(tokenize._Memo):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    monkeypatch.setattr(tokenize, "WORDS_AT_ONCE", 7)
    mine = Encoder(byte_bpe())
    mine.memo = Counted(tokenize.MEMO_BYTES)
    texts = ["one two\nthree one " + "two one " * n + "汉" for n in range(9)] + ["", "a  b", "one"]
    got = [np.frombuffer(e, "<u4").tolist() for e in mine.encode(texts)]
    assert got == [plain(t) for t in texts]
    assert mine.memo.asked <= 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZß.,'é-_~·ʯ s"), max_size=40), max_size=4))
def test_stems_and_tails_are_the_librarys(texts):
    got = [np.frombuffer(e, "<u4").tolist() for e in ENCODER.encode(texts)]
    assert got == [plain(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'st .\n\té1<|>"), max_size=30), max_size=4))
def test_random_ids_are_the_librarys(texts):
    got = [np.frombuffer(e, "<u4").tolist() for e in ENCODER.encode(texts)]
    assert got == [plain(t) for t in texts]


@pytest.mark.parametrize("n,kinds", [(0, 1), (1, 1), (5, 1), (1000, 3), (70_000, 5000),
                                     (600_000, 40_000)])
def test_blocks_come_back(n, kinds):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % kinds).astype(np.uint32)
    table = rans.Table.of(ids)
    read = rans.Table.from_bytes(table.to_bytes())
    assert int(read.freqs.sum()) == (1 << read.bits if n else 0)
    block = rans.encode(ids, table)
    assert np.array_equal(rans.decode(block, read), ids)
    if len(block["offsets"]) > 1:  # any part without the ones before it
        step = rans.CHECKPOINT_STEPS * block["lanes"]
        part = rans.decode_part(block, read.slots(), read.bits, 1)
        assert np.array_equal(part, ids[step:2 * step])


def test_damage_is_noticed():
    ids = np.arange(1000, dtype=np.uint32) % 50
    table = rans.Table.of(ids)
    block = rans.encode(ids, table)
    payload = bytearray(block["payload"])
    payload[3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.decode({**block, "payload": bytes(payload)}, table)


def test_files_hold_all_texts_in_order(spark, monkeypatch):
    texts = [None, "", "one two  three", "ünï cödé " * 50, "word " * 30_000, "same", "same", *ODD]
    rows = [(i * 7 % 11, t, "s", 5) for i, t in enumerate(texts)] + [(None, "no id", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, part int")
    path = scratch_path(spark, "tokens")
    tokenbinary.write_tokens(docs.repartition(3), path, byte_bpe())
    got = tokenbinary.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    assert len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    want = sorted((i if i is not None else -1, plain(t) + [2]) for i, t, *_ in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"])
                  for r in got) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = scratch_path(spark, "tokens")
    tokenbinary.write_tokens(docs, path, byte_bpe())
    assert tokenbinary.read_tokens(spark, path).count() == 0


def test_small_shards_and_blocks(monkeypatch):
    """The task's side, with limits so small that every document is a shard of many blocks."""
    monkeypatch.setattr(tokenbinary, "BLOCK_TOKENS", 7)
    encoded = [np.array([5, 6, 7] * 20, "<u4").tobytes(), np.array([1], "<u4").tobytes()]
    row = tokenbinary._shard(3, 1, [10, None], encoded).to_pylist()[0]
    assert len(row["blocks"]) == 9 and row["lengths"] == [60, 1]
    table = rans.Table.from_bytes(row["table"])
    ids = np.concatenate([rans.decode(b, table) for b in row["blocks"]])
    assert ids.tolist() == [5, 6, 7] * 20 + [1]
