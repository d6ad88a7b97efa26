"""HyperMinHash sketches: registers, bands and the corrected Jaccard estimate (numpy)."""

from __future__ import annotations

import numpy as np

from editsurge.llm.common import mix64

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
ROWS = 4                      # registers in a band
BANDS = BUCKETS // ROWS
MANTISSA = 10                 # bits kept below the leading one
_VALUE_BITS = 53              # of a hash, after the bucket's bits (exact in a double)
_SEED = np.uint64(0x5851F42D4C957F2D)


def registers(shingles: np.ndarray) -> np.ndarray:
    """BUCKETS registers of 16 bits: leading-zero count plus 1 in the upper 6 bits and
    MANTISSA bits after the leading one of the least hash in each bucket; 0 if empty."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if not len(shingles):
        return out
    v = np.sort(mix64(shingles ^ _SEED))
    bucket = (v >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    low = (v[first] >> np.uint64(64 - BUCKET_BITS - _VALUE_BITS)) & np.uint64((1 << _VALUE_BITS) - 1)
    length = np.frexp(low.astype(np.float64))[1]                  # bit length, exact below 2**53
    zeros = _VALUE_BITS - length
    shift = np.maximum(length - 1 - MANTISSA, 0)
    kept = np.where(length > 0, low & ((np.uint64(1) << np.maximum(length - 1, 0).astype(np.uint64)) - np.uint64(1)), np.uint64(0))
    mantissa = kept >> shift.astype(np.uint64)
    out[bucket[first]] = ((np.minimum(zeros, 62) + 1) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    return out


def band_keys(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of registers: a 64-bit key for each band, and whether the band has any register."""
    bands = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    packed = bands[:, :, 0] | bands[:, :, 1] << np.uint64(16) | bands[:, :, 2] << np.uint64(32) | bands[:, :, 3] << np.uint64(48)
    salt = mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))
    return mix64(packed ^ salt), packed != 0


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of buckets whose registers agree though the least elements differ:
    two values agree if they have the same leading-zero count and the same mantissa.
    With a and b elements in a bucket the least values have densities a(1-x)^(a-1) and
    b(1-x)^(b-1); summed over the register cells, whose widths are 2^-(z+1+MANTISSA),
    that is the sum over z of (mass of cell z under a) * (mass under b) / 2^MANTISSA."""
    a, b = np.maximum(n / BUCKETS, 1e-3)[:, None], np.maximum(m / BUCKETS, 1e-3)[:, None]
    z = np.arange(0, 40)[None, :]
    upper, lower = 2.0 ** -z, 2.0 ** -(z + 1)
    mass = lambda k: np.exp(-k * lower) - np.exp(-k * upper)
    return (mass(a) * mass(b)).sum(axis=1) / 2 ** MANTISSA


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates for rows of registers and the set sizes."""
    used = (x != 0) | (y != 0)
    equal = ((x == y) & used).sum(axis=1) / np.maximum(used.sum(axis=1), 1)
    c = collision_rate(n, m)
    return np.clip((equal - c) / (1 - c), 0, 1)


def low_bits(regs: np.ndarray) -> np.ndarray:
    """Two mantissa bits of every register (mixed with its zero count), as four 64-bit words a row."""
    bits = ((regs ^ (regs >> np.uint16(MANTISSA))) & np.uint16(3)).astype(np.uint64)
    parts = bits.reshape(len(regs), 4, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(parts, axis=2)
