"""Word shingles of whole texts as sets of 64-bit hashes (numpy, many texts at once)."""

from __future__ import annotations

import numpy as np

from editsurge.llm.common import MIX_A, mix64

WORDS = 5
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_PLACE = mix64(np.arange(1001, 1001 + WORDS, dtype=np.uint64)) | np.uint64(1)
_BASE = np.uint64(0x100000001B3)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def words_of(text: str) -> bytes:
    """UTF-8 with A-Z in lower case (other letters as they are)."""
    return text.encode("utf-8", "surrogatepass").lower()


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word; words are runs of bytes other than ASCII white space."""
    b = np.frombuffer(data, dtype=np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    space = _SPACE[b]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate([[True], space[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64)
    lead = starts[0]
    at = np.zeros(len(b), np.int64)
    at[lead:] = np.arange(lead, len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    with np.errstate(over="ignore"):
        values = _BYTE[b] * _powers(int(at.max()) + 1)[at]
        values[space] = 0
        return mix64(np.add.reduceat(values, starts))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; with fewer words, of the whole
    sequence; empty without words."""
    w = word_hashes(words_of(text)) if text else np.zeros(0, np.uint64)
    n = len(w)
    if not n:
        return w
    with np.errstate(over="ignore"):
        if n < WORDS:
            return mix64((w * _PLACE[:n]).sum(dtype=np.uint64) + MIX_A * np.uint64(n))[None]
        total = np.zeros(n - WORDS + 1, np.uint64)
        for k in range(WORDS):
            total += w[k: n - WORDS + 1 + k] * _PLACE[k]
        return np.unique(mix64(total))
