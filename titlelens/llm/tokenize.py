"""Token ids of whole texts, by the tokenizers library, for byte-level BPE vocabularies.

Such a vocabulary cuts a text into words before it merges bytes, and a word's ids do not depend
on its neighbours.  So each new word goes through the library once, and the ids of a text are put
together from a bounded memo: equal to encoding the whole text, some times as fast.  The memo
relies on two cuts that the vocabulary's pattern always makes where no two white-space characters
meet: in front of a space, and on both sides of a line break.  Text with other white space, and
any other kind of vocabulary, is given to the library whole.

Most of the library's time goes into cutting.  A word of Latin letters that ends in ASCII
punctuation or in nothing is always cut between the two, so its parts go to the library's model
by themselves, and the punctuation is not learnt with every word anew.  The classes of characters
used for that have been settled for long; other words are given to the library as they are.

The memo is bounded in bytes, and words beyond `LONG_WORD` characters are not kept, so text
without spaces cannot fill it.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# For each of the memo's two halves, unless asked otherwise.
MEMO_BYTES = 64 << 20
# What a kept word costs beside its characters and ids: two objects and a place in a table.
ENTRY_BYTES = 200
LONG_WORD = 64
# Words whose ids are put together at once.
WORDS_AT_ONCE = 1 << 16
# Stands in front of a word without a space before it; texts that hold it are encoded whole.
_START = "\x00"
_SPACE = re.compile(r"\s")
_PAIRS = ("  ", "\n\n", " \n", "\n ")
# Every white-space character but the space and the line break.
_OTHER = [chr(c) for c in range(0x10000) if chr(c).isspace() and chr(c) not in " \n"]
_OTHER_ASCII = [c for c in _OTHER if c.isascii()]
# Words that are cut here, with or without the mark: Latin letters, then ASCII punctuation.
_LATIN = re.compile(f"{_START}?[A-Za-zÀ-ÖØ-öø-ʯ]+([!-/:-@\\[-`{{-~]*)")


def _byte_letters() -> dict[int, str]:
    """How such vocabularies write bytes: printable ones as they are, the others from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


def _is_odd(text: str) -> bool:
    """Whether white space may meet white space, or the mark is in the text."""
    return (any(p in text for p in _PAIRS) or _START in text
            or any(c in text for c in (_OTHER_ASCII if text.isascii() else _OTHER)))


class _Memo(dict):
    """Ids of words.  Those asked for lately are kept when it is full."""

    def __init__(self, most: int):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.most, self.held = most, 0
        self.new: list[str] = []

    def __missing__(self, word: str) -> bytes | None:
        known = self.older.get(word)
        if known is None:
            self.new.append(word)
            self[word] = None  # until it is learnt
        else:  # only short words are kept
            self[word] = known
            self.held += ENTRY_BYTES + len(word) + len(known)
        return known

    def learn(self, word: str, ids: bytes) -> None:
        if len(word) > LONG_WORD:
            self.pop(word, None)
        else:
            self[word] = ids
            self.held += ENTRY_BYTES + len(word) + len(ids)

    def rotate(self) -> None:
        if self.held > self.most:
            self.older = dict(self)
            self.clear()
            self.held = 0


class Encoder:
    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before, model = told.get("pre_tokenizer") or {}, told.get("model") or {}
        added = [t["content"] for t in told.get("added_tokens", [])]
        self.by_word = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                        and not before.get("add_prefix_space") and not told.get("normalizer")
                        and model.get("type", "BPE") == "BPE" and not model.get("dropout")
                        and not any(_SPACE.search(t) or not t for t in added)
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"]
                                    for t in told.get("added_tokens", [])))
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.memo = _Memo(memo_bytes)
        self.tails = {"": b""}

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in done]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of texts that are not cut any more, by the library's model."""
        if not pieces:
            return []
        # None holds a line break, so all are written in the vocabulary's letters at once.  Those
        # of ASCII without controls are the characters themselves, but for the space.
        shown = "\n".join(pieces)
        if shown.isascii():
            shown = shown.replace(" ", _LETTERS[32]).split("\n")
        else:
            shown = shown.encode().decode("latin-1").translate(_LETTERS).split(_LETTERS[10])
        tokenize = self.model.tokenize
        return [array("I", [t.id for t in tokenize(letters)]).tobytes() for letters in shown]

    def _tail(self, tail: str) -> bytes:
        ids = self.tails.get(tail)
        if ids is None:
            ids = self._pieces([tail])[0]
            if len(tail) < 4:
                self.tails[tail] = ids
        return ids

    def _learn(self) -> dict[str, bytes]:
        """The ids of the new words, also of those too long to be kept."""
        memo = self.memo
        words, memo.new = memo.new, []
        ids, cut, stems, others = {}, [], {}, []
        match = _LATIN.fullmatch
        for word in words:
            latin = match(word)
            if latin is None or (self.added and self.added.search(word)):
                others.append(word)
                continue
            tail = latin[1]
            stem = word[:-len(tail)] if tail else word
            if tail:
                cut.append((word, stem, tail))
            if memo.get(stem) is None:
                known = memo.older.get(stem)
                if known is None:
                    stems[stem] = None
                else:
                    ids[stem] = known
        for some in ([s for s in stems if s.isascii()], [s for s in stems if not s.isascii()]):
            ids |= zip(some, self._pieces(
                [s[1:] if s.startswith(_START) else " " + s for s in some]))
        for stem in stems:
            memo.learn(stem, ids[stem])
        for word, stem, tail in cut:
            ids[word] = (ids.get(stem) or memo[stem]) + self._tail(tail)
            memo.learn(word, ids[word])
        found = self._whole([w[1:] if w.startswith(_START) else w if w == "\n" else " " + w
                             for w in others]) if others else []
        for word, known in zip(others, found):
            ids[word] = known
            memo.learn(word, known)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return self._whole(texts)
        memo = self.memo
        memo.rotate()
        odd = [_is_odd(t) for t in texts]
        lines = [_START + t.replace("\n", f" \n {_START}") for t, o in zip(texts, odd) if not o]
        done = iter(self._by_words(lines) if lines else ())
        whole = iter(self._whole([t for t, o in zip(texts, odd) if o]))
        return [next(whole) if o else next(done) for o in odd]

    def _by_words(self, lines: list[str]) -> list[bytes]:
        """The ids of texts with their marks.  Each distinct word is looked up once; the ids of a
        text are taken together by places."""
        memo = self.memo
        words = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        bounds = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        which = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        del words, coded
        ids = list(map(memo.__getitem__, distinct))
        if memo.new:
            new = self._learn()
            ids = [new[w] if i is None else i for w, i in zip(distinct, ids)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(counts) - counts
        out = []
        at = 0
        while at < len(lines):  # some texts at a time
            end = int(np.searchsorted(bounds, bounds[at] + WORDS_AT_ONCE, "right")) - 1
            end = min(len(lines), max(at + 1, end))
            some = which[bounds[at]:bounds[end]]
            n = counts[some]
            ends = np.cumsum(n)
            place = np.repeat(starts[some] - (ends - n), n)
            place += np.arange(len(place))
            taken = flat[place].tobytes()
            cuts = [0, *(4 * ends[bounds[at + 1:end + 1] - bounds[at] - 1]).tolist()]
            out += [taken[i:j] for i, j in zip(cuts, cuts[1:])]
            at = end
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str, memo_bytes: int = MEMO_BYTES) -> Encoder:
    """One per worker process, with its memo, for all tasks that run in it."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, memo_bytes)
    _encoders[path].memo.most = memo_bytes
    return _encoders[path]
