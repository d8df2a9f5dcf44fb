"""Sets of hashed word shingles, straight from the bytes of an Arrow text column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CODE = np.arange(1, 257, dtype=np.uint64)
_CODE[0x41:0x5B] = _CODE[0x61:0x7B]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words in `data`, and for each the text it is in.

    bounds: where the texts begin, and the end.  A word does not go over such a bound.
    """
    places = np.flatnonzero(~_SPACE[data])
    if not len(places):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    opens = np.ones(len(places), bool)
    opens[1:] = np.diff(places) > 1
    edges = np.searchsorted(places, bounds[1:-1])
    opens[edges[edges < len(places)]] = True
    first = np.flatnonzero(opens)
    lengths = np.diff(first, append=len(places))
    within = np.arange(len(places)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    sums = np.add.reduceat(_CODE[data[places]] * powers[within], first)
    hashes = _mixed(sums + lengths.astype(np.uint64) * _STEPS[0])
    return hashes, np.searchsorted(bounds, places[first], side="right") - 1


def _shingles(hashes: np.ndarray) -> np.ndarray:
    """All shingles of one run of words; fewer words than a shingle has are one shingle."""
    n = min(SHINGLE, len(hashes))
    if not n:
        return np.zeros(0, np.int64)
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    for j in range(n):
        total += hashes[j:len(hashes) - n + 1 + j] * _STEPS[j]
    return _mixed(total).view(np.int64)


def _long_text(data: np.ndarray) -> np.ndarray:
    """The word hashes of a text that is taken in pieces, cut at white space."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        while end < len(data) and not _SPACE[data[end]]:
            ahead = np.flatnonzero(_SPACE[data[end:end + PIECE_BYTES]])
            end = end + int(ahead[0]) if len(ahead) else min(len(data), end + PIECE_BYTES)
        piece = data[at:end]
        parts.append(_word_hashes(piece, np.array([0, len(piece)]))[0])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def text_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted signed 64-bit hashes; none for null."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        end = min(end, len(texts))
        bounds = offsets[at:end + 1] - offsets[at]
        part = data[offsets[at]:offsets[end]]
        if end == at + 1 and len(part) > PIECE_BYTES:
            yield np.unique(_shingles(_long_text(part)))
        else:
            hashes, owner = _word_hashes(part, bounds)
            cuts = np.searchsorted(owner, np.arange(end - at + 1))
            for i in range(end - at):
                yield np.unique(_shingles(hashes[cuts[i]:cuts[i + 1]]))
        at = end


def set_key(values: np.ndarray) -> int:
    """A number for a whole set: equal sets, equal numbers."""
    if not len(values):
        return 0
    x = _mixed(values.view(np.uint64) + _BASE)
    both = np.array([x.sum(dtype=np.uint64), np.bitwise_xor.reduce(
        _mixed(x + _STEPS[1])), len(values)], np.uint64)
    return int(_mixed((both * _STEPS[:3]).sum(dtype=np.uint64).reshape(1)).view(np.int64)[0])
