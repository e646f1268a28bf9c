"""Words of texts and their 64-bit codes, for whole Arrow columns at a time.

A word is a run of bytes other than space and the controls 9 to 13, with A-Z in lower case. Its code
is a random linear form of its bytes, mixed; different words share one with probability 2**-64 or so.
"""

from __future__ import annotations

import numpy as np

# What separates words.
GAPS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_GAP = np.zeros(256, bool)
_GAP[list(GAPS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
BYTE_CODES = np.random.default_rng(77).integers(1, 2**63, 256).astype(np.uint64)
_BYTE = BYTE_CODES[_LOWER]
BASE = 0x5851F42D4C957F2D
_INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_tables: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def _tables_for(n: int) -> list[np.ndarray]:
    if len(_tables[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        made = [_powers(BASE, size), _powers(_INVERSE, size)]
        if size > 4 * CHUNK:
            return made
        _tables[:] = made
    return _tables


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word of the rows whose bytes are ``raw`` between ``offsets``."""
    part = ~_GAP[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    begins = part.copy()
    begins[1:] &= ~part[:-1] | first[1:-1]
    ends = part.copy()
    ends[:-1] &= ~part[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def codes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The code of each word."""
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK, "right")))
        lo, hi = int(start[at]), int(end[to - 1])
        up, down = _tables_for(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[raw[lo:hi]] * up[: hi - lo], out=sums[1:])
        a, b = start[at:to] - lo, end[at:to] - lo
        out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        at = to
    return mixed(out)


def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The code of one code followed by another."""
    return mixed(first * np.uint64(0x9FB21C651E98DF25) + second)


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit integers with their bytes in planes, so that small ones (of ascending ones: small
    steps) compress."""
    values = values.astype(np.uint64)
    if ascending and len(values):
        values = np.concatenate([values[:1], values[1:] - values[:-1]])
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes, ascending: bool = False) -> np.ndarray:
    values = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(values, dtype=np.uint64) if ascending else values
