"""Vectorised text primitives over a batch of texts laid end to end as code points.

All functions work on whole Arrow batches with NumPy: no Python loop over words or lines.
A batch is one code-point array with a line feed after each text.
"""

from __future__ import annotations

import functools
import sys

import numpy as np

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
_INV = U64(pow(int(BASE), -1, 1 << 64))
LETTER, DIGIT, SPACE, UPPER = 1, 2, 4, 8


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Class bits and lower-case partner of every code point."""
    n = sys.maxunicode + 1
    kind, low = np.zeros(n, np.uint8), np.arange(n, dtype=np.uint32)
    for i in range(n):
        c = chr(i)
        if c.isalnum():
            kind[i] = DIGIT if c.isdigit() else LETTER
        elif c.isspace():
            kind[i] = SPACE
        lc = c.lower()
        if lc != c:
            kind[i] |= UPPER
            if len(lc) == 1:
                low[i] = ord(lc)
    return kind, low


_POWERS: list[np.ndarray] = [np.empty(0, U64), np.empty(0, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to at least n; one table that grows."""
    if len(_POWERS[0]) < n:
        n = 1 << max(16, (n - 1).bit_length())
        p, q = np.empty(n, U64), np.empty(n, U64)
        p[0] = q[0] = 1
        with np.errstate(over="ignore"):
            m, bp, bq = 1, BASE, _INV
            while m < n:  # doubling
                k = min(m, n - m)
                p[m : m + k] = p[:k] * bp
                q[m : m + k] = q[:k] * bq
                bp, bq, m = bp * bp, bq * bq, 2 * m
        _POWERS[:] = [p, q]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads entropy over all 64 bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(code points with a line feed after every text, start of each text; one more at the end)."""
    raw = "\n".join("" if t is None else t for t in texts) + "\n"
    cp = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((1 if t is None else len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    return cp, starts


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """H with span hash(s, e) = (H[e] - H[s]) * BASE**-s; see span_hash."""
    p, _ = powers(len(values) + 1)
    h = np.empty(len(values) + 1, U64)
    h[0] = 0
    np.cumsum((values.astype(U64) + U64(1)) * p[: len(values)], out=h[1:])
    return h


def span_hash(h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    _, q = powers(len(h))
    return mix((h[e] - h[s]) * q[s] + (e - s).astype(U64) * U64(0x632BE59BD9B4E019))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; mask must end with False."""
    d = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8)))))
    return d[0::2], d[1::2]


def words(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters and digits: (start, end, hash of the lower-cased word, lower-cased codes)."""
    kind, low = tables()
    k = kind[cp]
    lc = low[cp]
    s, e = runs((k & (LETTER | DIGIT)) != 0)
    return s, e, span_hash(prefix_hash(lc), s, e), lc


def minhash(values: np.ndarray, owner_starts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Minimum over each owner's values of every seeded hash: (owners, seeds) uint32.

    owner_starts: first value of each owner; every owner has at least one value.
    Works in blocks that fit the cache.
    """
    out = np.empty((len(owner_starts), len(seeds)), np.uint32)
    n = len(values)
    block, lo = 1 << 15, 0
    ends = np.append(owner_starts[1:], n)
    while lo < len(owner_starts):
        hi = max(lo + 1, int(np.searchsorted(ends, owner_starts[lo] + block, "right")))
        v = values[owner_starts[lo] : ends[hi - 1]]
        at = owner_starts[lo:hi] - owner_starts[lo]
        for j, a in enumerate(seeds):
            out[lo:hi, j] = np.minimum.reduceat(((v * a) >> U64(32)).astype(np.uint32), at)
        lo = hi
    return out


def seeds(n: int, salt: int = 1) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt)) | U64(1)


def band_keys(sig: np.ndarray, rows: int, salt: int = 0) -> np.ndarray:
    """Hash of every ``rows`` columns of a signature: (owners, bands) int64."""
    bands = sig.shape[1] // rows
    out = np.empty((len(sig), bands), np.int64)
    for b in range(bands):
        h = np.full(len(sig), salt * 1000003 + b + 1, U64)
        for j in range(rows):
            h = mix(h * BASE + sig[:, b * rows + j].astype(U64))
        out[:, b] = h.view(np.int64)
    return out
