"""Vectorised word hashing on UTF-8 bytes, shared by the operators on word windows.

A word is ``[^\\x20\\x09-\\x0D]+``. Those separators are single ASCII bytes, so
words are found on the UTF-8 bytes without decoding. A word's hash is a
polynomial in its bytes (mod 2^64, random byte values, odd base), taken from
one prefix sum over the text and finished by a bit mixer; a window's hash is
the same construction over word hashes.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i (mod 2^64) for i < n; kept up to 2^20 entries."""
    have = _powers.get(lane)
    if have is not None and len(have[0]) >= n:
        return have
    size = max(1 << 16, 1 << (n - 1).bit_length())
    base = int(_BASES[lane])
    with np.errstate(over="ignore"):
        up = np.full(size, np.uint64(base))
        down = np.full(size, np.uint64(pow(base, -1, 2**64)))
        up[0] = down[0] = np.uint64(1)
        made = np.multiply.accumulate(up), np.multiply.accumulate(down)
    if size <= 1 << 20:
        _powers[lane] = made
    return made


def mix(x: np.ndarray, in_place: bool = False) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    if not in_place:
        x = x.copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
    up, down = _power_tables(lane, len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a UTF-8 text."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word, equal for equal words."""
    starts, ends = word_spans(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    return _rolling(BYTE_VALUES[np.frombuffer(data, np.uint8)], starts, ends, 0)


def window_hashes(words: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """One 64-bit hash per window of ``length`` consecutive word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return _rolling(words, starts, starts + length, lane)
