"""Content-defined anchors of byte strings: where equal 100-byte strings meet (numpy).

Every 100-byte window has one anchor: among the ``GRAM``-byte grams inside it the one
with the least hash (the leftmost of equals).  Equal windows have their anchor at
the same offset and with the same gram, so all occurrences of a window carry the
same anchor key.  Consecutive windows mostly share their anchor; such a run of windows
is one record, whose context is the bytes they cover.
"""

from __future__ import annotations

import numpy as np

from editsurge.llm.common import mix64

WINDOW = 100
GRAM = 32
SPAN = WINDOW - GRAM + 1           # grams inside a window
_POSITION = np.uint64((1 << 24) - 1)
CHUNK = 1 << 22                    # windows looked at together
_BYTE = mix64(np.arange(500, 756, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    cur, length, power = _BYTE[b], 1, _BASE
    with np.errstate(over="ignore"):
        while length < GRAM:
            cur = cur[:-length] * power + cur[length:]
            length, power = 2 * length, power * power
    return mix64(cur)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def _window_least(v: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` (block prefix and suffix minima)."""
    n = len(v) - width + 1
    pad = -len(v) % width
    x = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(x, axis=1).ravel()
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1: width - 1 + n])


def records(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, context hash, anchor, first window, last window) of every run of windows
    that share an anchor, in order; empty below 100 bytes."""
    parts = []
    n = len(data) - WINDOW + 1
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, n, CHUNK):
        end = min(at + CHUNK, n)
        b = whole[at: end + WINDOW - 1]
        grams = _gram_hashes(b)
        v = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_window_least(v, SPAN) & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.append(first[1:], len(anchor)) - 1
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _powers(_BASE, len(b)), dtype=np.uint64)])
            shape = ((last - first) << 8 | (anchor[first] - first)).astype(np.uint64)
            context = mix64((sums[last + WINDOW] - sums[first]) * _powers(_INVERSE, len(b) + 1)[first] + mix64(shape))
        parts.append((grams[anchor[first]], context, anchor[first] + at, first + at, last + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*parts))


class Hashes:
    """Prefix sums over a byte string, for hashes of any of its substrings."""

    def __init__(self, b: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _powers(_BASE, len(b)), dtype=np.uint64)])
        self.back = _powers(_INVERSE, len(b) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each [start, end); the empty string has one of its own."""
        with np.errstate(over="ignore"):
            return mix64((self.sums[end] - self.sums[start]) * self.back[start] + mix64((end - start).astype(np.uint64)))


def cut_points(b: np.ndarray) -> np.ndarray:
    """Positions whose four bytes say so (about one in eight): the same for equal strings."""
    if len(b) < 4:
        return np.zeros(0, np.int64)
    x = b[:-3].astype(np.uint64)
    for k in range(1, 4):
        x = x | b[k: len(b) - 3 + k].astype(np.uint64) << np.uint64(8 * k)
    return np.flatnonzero((mix64(x) & np.uint64(7)) == 0)
