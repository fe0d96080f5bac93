"""Byte-level helpers that the corpus operators run inside tasks: words and hashes of many texts at once with numpy.

Words are maximal runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return; no byte of a
longer UTF-8 sequence is one of these, so words of bytes and words of characters are the same. Lower case means A-Z only.
Hashes are 64-bit polynomial hashes over random byte values with an odd base, finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.RandomState(20240229).randint(1, 2**63 - 1, 256).astype(np.uint64)
_SPACE_MASK = np.zeros(256, bool)
_SPACE_MASK[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash; a bijection, works in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n or more of each, kept for the next call."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[size] = tuple(out)
    return _powers[size]


class Hasher:
    """Prefix sums over a byte array: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        self.power, self.inverse = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.power[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], finished; equal substrings have equal hashes wherever they stand."""
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of the texts that lie in `data` from rows[i] to rows[i + 1]; none crosses a row."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~_SPACE_MASK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[rows] = True
    starts = np.flatnonzero(word[1:] & (cut | ~word[:-1]))
    ends = np.flatnonzero(word[:-1] & (cut | ~word[1:]))
    return starts, ends


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after the other, and the row bounds (one more than rows). Null rows are empty."""
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def pieces(batches: Iterable[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about `size` bytes of text, or one row that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
