"""Byte n-grams of many texts at once, as 64-bit integers, and fast look-up of their values.

The n-gram ending at a byte is the integer of that byte and the ``order - 1`` bytes before it, most recent
byte lowest; before a text's start there are zero bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at a time.
CHUNK = 1_000_000


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``CHUNK`` bytes (a longer text is alone): index of the first, their bytes."""
    start, size, held = 0, 0, []
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        if held and size + len(raw) > CHUNK:
            yield start, held
            start, size, held = i, 0, []
        held.append(raw)
        size += len(raw)
    if held:
        yield start, held


def keys(raws: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram at each byte of all texts, one text after another, and the texts' lengths."""
    pad = bytes(order - 1)
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    buf = np.frombuffer(pad + pad.join(raws), np.uint8)
    n = int(lengths.sum()) + (order - 1) * (len(raws) - 1)
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(order):
        out <<= np.uint64(8)
        out |= buf[j:j + n]
    if len(raws) > 1:  # n-grams that end inside the zeros between two texts
        inside = np.ones(n, bool)
        gaps = np.cumsum(lengths[:-1] + order - 1) - (order - 1)
        for j in range(order - 1):
            inside[gaps + j] = False
        out = out[inside]
    return out, lengths


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per-text sums (along the first axis) of per-byte values; 0 for an empty text."""
    out = np.zeros((len(lengths), *values.shape[1:]))
    some = np.flatnonzero(lengths)
    if len(some):
        starts = np.concatenate([[0], np.cumsum(lengths[some])[:-1]])
        out[some] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out


def counted(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a sorted array and how often each occurs."""
    if not len(sorted_keys):
        return sorted_keys, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return sorted_keys[at], np.diff(np.concatenate([at, [len(sorted_keys)]]))


class Index:
    """Row number of a key among sorted distinct keys, -1 if it isn't there."""

    def __init__(self, sorted_keys: np.ndarray):
        self.keys = sorted_keys
        bits = max(10, int(len(sorted_keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        slot = self._slot(sorted_keys)
        self.first = np.full(1 << bits, -1, np.int32)
        self.first[slot[::-1]] = np.arange(len(sorted_keys), dtype=np.int32)[::-1]
        used, n = np.unique(slot, return_counts=True)
        self.shared = np.zeros(1 << bits, bool)
        self.shared[used[n > 1]] = True

    def _slot(self, k: np.ndarray) -> np.ndarray:
        return ((k * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, k: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(k), -1, np.int32)
        slot = self._slot(k)
        row = self.first[slot]
        wrong = self.keys[row] != k
        if wrong.any():
            again = wrong & self.shared[slot]
            row[wrong] = -1
            if again.any():
                k = k[again]
                at = np.searchsorted(self.keys, k)
                at[at == len(self.keys)] = 0
                row[again] = np.where(self.keys[at] == k, at, -1)
        return row
