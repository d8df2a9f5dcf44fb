"""Blocked Bloom filters of words, and the hashes of all words that are one edit away.

A word's hash is a polynomial in its code points, modulo 2^64, so that the hash of an edited word
comes from the word's own by an addition or a shift of what follows, for whole arrays at once.
A filter is made of blocks of 256 bits; a word sets one bit in each of the eight lanes of one
block.  Sixteen bits a word keep false positives below one in a thousand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LANES = 8
WORDS_A_BLOCK = 16  # of 256 bits
BLOCK_BYTES = 32
EDITS_AT_ONCE = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Odd numbers, one a lane.
_LANE = np.cumprod(np.full(LANES, 0xD6E8FEB8, np.uint32)
                   | np.uint32(1), dtype=np.uint32) ^ np.uint32(0x5BD1E994)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row a word."""
    raw = "".join(words).encode("utf-32-le")
    return np.frombuffer(raw, "<u4").reshape(len(words), length).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.full(length, _BASE, np.uint64))


def hashes(points: np.ndarray) -> np.ndarray:
    """The mixed hash of each word."""
    return _mixed((points * _powers(points.shape[1])).sum(axis=1, dtype=np.uint64))


def slice_of(hashed: np.ndarray, slices: int) -> np.ndarray:
    """Which of the equal parts of a length a word is in."""
    return ((hashed >> np.uint64(40)) % np.uint64(slices)).astype(np.int64)


def _block_of(hashed: np.ndarray, blocks: int) -> np.ndarray:
    return ((((hashed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)) * np.uint64(
        LANES)).astype(np.int64)


def _bit(hashed: np.ndarray, lane: int) -> np.ndarray:
    low = hashed.astype(np.uint32) * _LANE[lane]
    return np.uint32(1) << (low >> np.uint32(27))


def empty(words: int) -> np.ndarray:
    return np.zeros(max(1, -(-words // WORDS_A_BLOCK)) * LANES, np.uint32)


def add(held: np.ndarray, hashed: np.ndarray) -> None:
    block = _block_of(hashed, len(held) // LANES)
    for lane in range(LANES):
        np.bitwise_or.at(held, block + lane, _bit(hashed, lane))


def probe(held: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Places in `hashed` that may be in the filter; each lane looks only at what passed."""
    block = _block_of(hashed, len(held) // LANES)
    left = np.arange(len(hashed))
    for lane in range(LANES):
        hit = held[block + lane] & _bit(hashed, lane) != 0
        left, block, hashed = left[hit], block[hit], hashed[hit]
        if not len(left):
            break
    return left


def deletions(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word, place, mixed hash) of every different word that is one code point shorter."""
    n, length = points.shape
    terms = points * _powers(length)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = terms.sum(axis=1, dtype=np.uint64)[:, None] - before - terms
    # Of equal code points in a row only the first is left out.
    first = np.ones((n, length), bool)
    first[:, 1:] = points[:, 1:] != points[:, :-1]
    word, place = np.nonzero(first)
    yield word, place, _mixed(before[first] + after[first] * _UNBASE)


def replacements(points: np.ndarray, alphabet: np.ndarray
                 ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(word, place, new code point, mixed hash) of every word with a greater code point at one
    place; the pairs the other way round come from the other word."""
    n, length = points.shape
    powers = _powers(length)
    whole = (points * powers).sum(axis=1, dtype=np.uint64)
    width = max(1, EDITS_AT_ONCE // max(1, n * len(alphabet)))
    for at in range(0, length, width):
        old = points[:, at:at + width, None]
        greater = alphabet[None, None, :] > old
        word, place, new = np.nonzero(greater)
        moved = (alphabet[new] - points[word, at + place]) * powers[at + place]
        yield word, at + place, alphabet[new], _mixed(whole[word] + moved)
