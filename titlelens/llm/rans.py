"""Range asymmetric numeral system with a static table, many interleaved states and checkpoints.

A block's symbols are dealt to `lanes` states in turn; all states take one step together.  A
checkpoint holds the states and the place in the payload from which decoding can start without
what lies before it, so that parts of a block are decoded independently of each other.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LOWEST = np.uint64(1 << 31)
WORD_BITS = np.uint64(32)
MAX_LANES = 4096
CHECKPOINT_STEPS = 128


@dataclass
class Table:
    """The symbols in use, with frequencies that add up to a power of two."""

    symbols: np.ndarray
    freqs: np.ndarray
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> "Table":
        counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
        symbols = np.flatnonzero(counts).astype(np.uint32)
        counts = counts[symbols]
        bits = min(24, max(12, int(max(len(symbols), 1) - 1).bit_length() + 3))
        freqs = np.maximum(1, counts * (1 << bits) // max(1, counts.sum()))
        while (over := int(freqs.sum()) - (1 << bits)) > 0:  # rare symbols were rounded up
            most = int(np.argmax(freqs))
            freqs[most] -= min(over, max(1, int(freqs[most]) // 2))
        if len(freqs):
            freqs[int(np.argmax(freqs))] += (1 << bits) - int(freqs.sum())
        return cls(symbols, freqs.astype(np.uint64), bits)

    def to_bytes(self) -> bytes:
        gaps = np.diff(self.symbols.astype("<i8"), prepend=0).astype("<u4")
        raw = gaps.tobytes() + self.freqs.astype("<u4").tobytes()
        return zlib.compress(bytes([self.bits]) + raw, 6)

    @classmethod
    def from_bytes(cls, data: bytes) -> "Table":
        raw = zlib.decompress(data)
        both = np.frombuffer(raw, "<u4", offset=1).reshape(2, -1)
        return cls(np.cumsum(both[0], dtype=np.uint64).astype(np.uint32),
                   both[1].astype(np.uint64), raw[0])

    @property
    def starts(self) -> np.ndarray:
        return (np.cumsum(self.freqs) - self.freqs).astype(np.uint64)

    def slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each slot: the symbol, its frequency, and the slot's place within the symbol."""
        times = self.freqs.astype(np.int64)
        place = np.arange(1 << self.bits, dtype=np.uint64)[:int(times.sum())]
        return (np.repeat(self.symbols, times), np.repeat(self.freqs, times),
                place - np.repeat(self.starts, times))


def encode(ids: np.ndarray, table: Table) -> dict:
    """A block: payload, checkpoints and checksum."""
    n = len(ids)
    lanes = int(min(MAX_LANES, max(1, n // 32)))
    place = np.zeros(int(table.symbols[-1]) + 1 if n else 0, np.int64)
    place[table.symbols if n else []] = np.arange(len(table.symbols) if n else 0)
    freqs, starts = table.freqs[place[ids]], table.starts[place[ids]]
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    states = np.full(lanes, LOWEST, np.uint64)
    words, written, marks = [], 0, []
    for step in reversed(range(-(-n // lanes))):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        f = freqs[at]
        x = states[:len(f)]
        full = x >= (f << room)
        out = x[full]
        words.append(out.astype("<u4"))
        written += len(out)
        x[full] = out >> WORD_BITS
        q = x // f
        states[:len(f)] = (q << bits) + (x - q * f) + starts[at]
        if step % CHECKPOINT_STEPS == 0:
            marks.append((written, states.copy()))
    marks.reverse()
    payload = np.concatenate(words[::-1]).tobytes() if words else b""
    offsets = [written - w for w, _ in marks]
    held = b"".join(s.astype("<u8").tobytes() for _, s in marks)
    return {"n_tokens": n, "lanes": lanes, "offsets": offsets, "states": held,
            "payload": payload, "crc32": zlib.crc32(payload, zlib.crc32(held))}


def verify(block: dict) -> None:
    if zlib.crc32(block["payload"], zlib.crc32(block["states"])) != block["crc32"]:
        raise ValueError("a token block does not match its checksum")


def decode_part(block: dict, slots, bits: int, part: int) -> np.ndarray:
    """The ids from checkpoint `part` up to the next."""
    symbols, freqs, places = slots
    lanes, n = block["lanes"], block["n_tokens"]
    ends = [*block["offsets"], len(block["payload"]) // 4]
    words = np.frombuffer(block["payload"], "<u4")[ends[part]:ends[part + 1]].astype(np.uint64)
    states = np.frombuffer(block["states"], "<u8").reshape(-1, lanes)[part].astype(np.uint64)
    first = part * CHECKPOINT_STEPS * lanes
    last = min(n, first + CHECKPOINT_STEPS * lanes)
    out = np.empty(last - first, np.uint32)
    mask, shift, read = np.uint64((1 << bits) - 1), np.uint64(bits), 0
    for at in range(0, last - first, lanes):
        k = min(lanes, last - first - at)
        x = states[:k]
        slot = (x & mask).astype(np.int64)
        out[at:at + k] = symbols[slot]
        x = freqs[slot] * (x >> shift) + places[slot]
        low = np.flatnonzero(x < LOWEST)
        x[low] = (x[low] << WORD_BITS) | words[read:read + len(low)]
        read += len(low)
        states[:k] = x
    return out


def decode(block: dict, table: Table, slots=None) -> np.ndarray:
    """All ids of a block."""
    verify(block)
    slots = slots or table.slots()
    parts = [decode_part(block, slots, table.bits, p) for p in range(len(block["offsets"]))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
