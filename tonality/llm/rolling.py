"""Word codes, rolling (Rabin-Karp) hashes of word windows, and bit filters of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A slice's arrays take about 40 times its bytes, in every Python worker at once.
SLICE_BYTES = 1 << 19
BITS_A_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix64(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64))
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of ``base``; up to a slice's length they are kept."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        with np.errstate(over="ignore"):
            held = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))), dtype=np.uint64)
        if n <= SLICE_BYTES + 1:
            _POWERS[base] = held
    return held[:n]


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after every word."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], SPACE[raw], [True])).view(np.int8)))
    return edge[::2], edge[1::2]


def word_codes(raw: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """uint64 code of every word: the Rabin-Karp hash of its bytes, mixed with its length. A word's
    code does not depend on its place, so long texts go slice by slice."""
    out, at = np.zeros(len(first), np.uint64), 0
    while at < len(first):
        low = first[at]
        end = max(at + 1, int(np.searchsorted(after, low + SLICE_BYTES, "right")))
        part = raw[low:after[end - 1]]
        with np.errstate(over="ignore"):
            sums = np.concatenate(([np.uint64(0)], np.cumsum(BYTE_CODES[part] * powers(INVERSE, len(part)), dtype=np.uint64)))
            a, b = first[at:end] - low, after[at:end] - low
            out[at:end] = mix64((sums[b] - sums[a]) * powers(BASE, len(part) + 1)[a] + (b - a).astype(np.uint64))
        at = end
    return out


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of code * B**-i, from which the hash of any window follows."""
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(0)], np.cumsum(codes * powers(INVERSE, len(codes)), dtype=np.uint64)))


def window_hashes(sums: np.ndarray, window: int) -> np.ndarray:
    """Rabin-Karp hash of the ``window`` codes from every place on, rolled by their prefix sums."""
    n = len(sums) - window
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        return mix64((sums[window:] - sums[:n]) * powers(BASE, n))


def bit_filter(hashes: DataFrame, column: str, bits_a_key: int = BITS_A_KEY, most_bits: int = MOST_BITS) -> tuple[int, np.ndarray]:
    """How many hashes there are, and a filter of them for ``passes``: a power of two of bits, about
    ``bits_a_key`` for each hash but at most ``most_bits`` (16 MB), whatever the input. It
    holds every hash; beyond that bound more others pass too, so it may only save work."""
    n = hashes.count()
    size = LEAST_BITS
    while size < min(n * bits_a_key, most_bits):
        size *= 2
    slot = F.col(column).bitwiseAND(F.lit(size - 1))
    found = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    flags = np.zeros(size // 64, np.int64)
    flags[found["at"].to_numpy()] = found["bits"].to_numpy()
    return n, flags.view(np.uint64)


def passes(flags: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(len(flags) * 64 - 1)
    return (flags[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
