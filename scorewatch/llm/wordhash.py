"""Words of a batch of texts and their 64-bit hashes, as whole-array numpy."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 truth values: true for the bytes in the closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low: high + 1] = True
    return table


#: Letters, digits and every byte of a non-ASCII character.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalizer that spreads every input bit (splitmix64)."""
    h = h + np.uint64((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes, and the row it is in.
    Runs end at row borders."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[buf]
    border = np.zeros(len(buf) + 1, bool)
    border[offsets] = True
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 21:
            _powers[int(base)] = have
    return have[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0,
                chunk: int = 1 << 19) -> np.ndarray:
    """Hash of ``buf[start:end]`` for each span; spans are in ascending order.
    Works chunk by chunk, so memory follows the chunk, not the text."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(int(np.searchsorted(ends, low + chunk, "right")), i + 1)
        part = buf[low: int(ends[j - 1])].astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _power(_BASE, len(part)), out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (total[e] - total[s]) * _power(_INVERSE, len(part) + 1)[s]
        i = j
    return mix(out, seed)
