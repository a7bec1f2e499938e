"""Words and shingles of many texts at once, as 64-bit hashes in numpy.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased.
"""

from __future__ import annotations

import numpy as np

from jobmarket.llm.common import Rolling, mix

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False

#: Factor that combines the hashes of a shingle's words.
STEP = np.uint64(0xD6E8FEB86659FD93)


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words of consecutive texts that share one byte array; words never cross texts."""
    w = IS_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    starts = np.flatnonzero(w & (first[:-1] | np.concatenate([[True], ~w[:-1]])))
    ends = np.flatnonzero(w & (first[1:] | np.concatenate([~w[1:], [True]]))) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def words_of(data: np.ndarray, off: np.ndarray, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, in order, and their rows."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    starts, ends, rows = word_spans(data, off)
    return mix(rolling.spans(rolling.prefix(LOWER[data]), starts, ends)), rows


def joined(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; the order counts."""
    h = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        h = h * STEP + words[i : len(words) - n + 1 + i]
    return mix(h + np.uint64(n))


def shingle_sets(data: np.ndarray, off: np.ndarray, rolling: Rolling, n: int) -> list[np.ndarray]:
    """Per text its sorted distinct n-word shingles; a shorter text is one shingle, a text without words none."""
    words, rows = words_of(data, off, rolling)
    at = np.searchsorted(rows, np.arange(len(off)))
    out = []
    full = joined(words, n) if len(words) >= n else np.empty(0, np.uint64)
    for r in range(len(off) - 1):
        a, b = at[r], at[r + 1]
        if b - a >= n:
            out.append(np.unique(full[a : b - n + 1]))
        elif b > a:
            out.append(joined(words[a:b], int(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
