"""Hashes of byte ranges by prefix sums: any range of a text in constant time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# The seed of the byte table and the odd bases of the polynomials.
_SEED = 20240229
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """A 64-bit number for each byte, the same in every process."""
    return np.random.default_rng(_SEED).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base^0 … base^(count-1) modulo 2^64; kept up to the longest text seen."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        size = max(1 << 16, 1 << int(count - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:count]


@lru_cache(maxsize=8)
def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one-to-one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Return a hash of each raw[begin:end], eight bytes of all of them at a time.

    What is read is mixed before the next eight bytes come in, so that words made to have equal
    sums do not meet.
    """
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded.data, strides=(1,))
    left = end - begin
    out = mixed(left.astype(np.uint64) + np.uint64(_SEED))
    at, some = begin, np.arange(len(begin))
    while len(some):
        unread = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
        read = eight[at] << unread >> unread
        out[some] = mixed((out[some] ^ read) * np.uint64(BASES[0]) + np.uint64(BASES[1]))
        more = left > 8
        at, left, some = at[more] + 8, left[more] - 8, some[more]
    return out


def prefix_sums(data: np.ndarray, base: int) -> np.ndarray:
    """Return sums s with s[e] - s[b] = base^b times the polynomial of data[b:e]."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_table()[data] * powers(base, len(data)), out=out[1:])
    return out


def range_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Return a mixed hash of each data[begin:end], equal for equal bytes wherever they are."""
    back = powers(inverse(base), len(sums))
    return mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def sliding_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Return a mixed hash of every window of ``width`` bytes."""
    base = BASES[0]
    step = lambda n: np.uint64(pow(base, n, 1 << 64))
    current, length, out, done, left = byte_table()[data], 1, None, 0, width
    while True:
        if left & 1:
            if out is None:
                out, done = current, length
            else:
                size = len(data) - done - length + 1
                out = out[:size] * step(length) + current[done : done + size]
                done += length
        left >>= 1
        if not left:
            return mixed(out)
        size = len(data) - 2 * length + 1
        current = current[:size] * step(length) + current[length : length + size]
        length *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Return the least value of every window of ``width`` values."""
    current, length = values, 1
    while length * 2 <= width:
        size = len(current) - length
        current = np.minimum(current[:size], current[length:])
        length *= 2
    size = len(values) - width + 1
    return np.minimum(current[:size], current[width - length : width - length + size])
