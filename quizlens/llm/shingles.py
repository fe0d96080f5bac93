"""Sets of word shingles of many texts at once.

A text's set holds its distinct runs of `width` words in lower case (A-Z); a text with fewer words has its whole word sequence as the
only element, a text without words has the empty set. Elements are 64-bit hashes of the words' hashes in order.
"""

from __future__ import annotations

import numpy as np

from quizlens.llm.text import Hasher, lowered, mix, word_bounds

WIDTH = 5
_ORDER = [np.uint64(0xD6E8FEB86659FD93 * (2 * k + 1) % (1 << 64) | 1) for k in range(64)]


def shingle_sets(data: np.ndarray, rows: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted sets of the texts that lie in `data` from rows[i] to rows[i + 1]: all elements, and the bounds per text."""
    n = len(rows) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    starts, ends = word_bounds(data, rows)
    hashes = Hasher(lowered(data))(starts, ends)
    first = np.searchsorted(starts, rows)  # first word of each text
    count = np.diff(first)
    here = np.minimum(count, width)
    shingles = np.where(count == 0, 0, np.maximum(count - width + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    text_of = np.repeat(np.arange(n), shingles)
    at = np.arange(bounds[-1]) - bounds[text_of] + first[text_of]
    value = np.zeros(len(at), np.uint64)
    for k in range(width):
        full = here[text_of] > k
        value[full] += (hashes[at[full] + k] ^ np.uint64(k + 1)) * _ORDER[k]
    value += here[text_of].astype(np.uint64)  # a short text is no shingle of a longer one
    mix(value)
    out, sizes = [], np.zeros(n, np.int64)
    for i in range(n):
        s = value[bounds[i] : bounds[i + 1]]
        if len(s) > 1:
            s = np.sort(s)
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        sizes[i] = len(s)
        out.append(s)
    return (np.concatenate(out) if out else value), np.concatenate([[0], np.cumsum(sizes)])
