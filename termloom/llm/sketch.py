"""One-permutation hashing with optimal densification, over whole batches.

A set of shingles is hashed once; the hash chooses a bin and the least value in
each bin is the sketch.  An empty bin takes the value of a bin chosen by a
universal hash of (bin, attempt), the same for every row, which keeps the
estimate of the Jaccard similarity unbiased and of least variance.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after another, and the offset of each text (one more than texts)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=ends[1:])
    return flat, ends


_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _windows(flat: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of every stretch of ``n`` code points at a cost that does not depend on ``n``: differences of weighted sums."""
    if len(flat) < n:
        return np.zeros(0, np.uint64)
    up, down = np.full(len(flat), _BASE), np.full(len(flat), _INVERSE)
    up[0] = down[0] = 1
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(mix(flat + np.uint64(seed * 2 + 1)) * np.cumprod(up), out=total[1:])
    return mix((total[n:] - total[:-n]) * np.cumprod(down)[: len(flat) - n + 1])


def char_shingles(texts: list[str], n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Row number and hash of every n-gram of characters; a shorter text is one shingle."""
    flat, ends = code_points(texts)
    lengths = np.diff(ends)
    rows = np.repeat(np.arange(len(texts)), np.maximum(lengths - n + 1, 0))
    first = np.repeat(ends[:-1], np.maximum(lengths - n + 1, 0))
    within = np.arange(len(rows)) - np.repeat(np.cumsum(np.maximum(lengths - n + 1, 0)) - np.maximum(lengths - n + 1, 0), np.maximum(lengths - n + 1, 0))
    at = first + within
    with np.errstate(over="ignore"):
        if n < 4:
            h = np.full(len(rows), np.uint64(seed * 2 + 1), dtype=np.uint64)
            for k in range(n):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + flat[at + k])
        else:
            h = _windows(flat, n, seed)[at]
        short = np.flatnonzero((lengths < n) & (lengths > 0))
        if len(short):
            extra = []
            for r in short:
                v = np.array([seed * 2 + 1], dtype=np.uint64)
                for c in flat[ends[r] : ends[r + 1]]:
                    v = mix(v * np.uint64(0x9E3779B97F4A7C15) + c)
                extra.append(v[0])
            rows = np.concatenate([rows, short])
            h = np.concatenate([h, np.array(extra, dtype=np.uint64)])
    return rows, h


def _detours(bins: int, attempts: int = 64) -> np.ndarray:
    i = np.arange(bins, dtype=np.uint64)[:, None]
    j = np.arange(1, attempts + 1, dtype=np.uint64)[None, :]
    with np.errstate(over="ignore"):
        return (mix(i * np.uint64(0xD1B54A32D192ED03) + j * np.uint64(0x8CB92BA72F3D8DD7)) % np.uint64(bins)).astype(np.int64)


def sketch(rows: np.ndarray, hashes: np.ndarray, n_rows: int, bins: int) -> np.ndarray:
    """The densified sketch, ``n_rows`` by ``bins``; rows without shingles stay ``EMPTY``."""
    out = np.full(n_rows * bins, EMPTY, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = mix(hashes)
    cell = rows * bins + (h % np.uint64(bins)).astype(np.int64)
    np.minimum.at(out, cell, h)
    out = out.reshape(n_rows, bins)
    filled = out.copy()
    empty = out == EMPTY
    some = ~empty.all(axis=1)
    detours = _detours(bins)
    r, b = np.nonzero(empty & some[:, None])
    for k in range(detours.shape[1]):
        if not len(r):
            break
        v = out[r, detours[b, k]]
        hit = v != EMPTY
        with np.errstate(over="ignore"):
            filled[r[hit], b[hit]] = v[hit]
        r, b = r[~hit], b[~hit]
    return filled


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash from several, element by element."""
    out = np.zeros_like(parts[0])
    with np.errstate(over="ignore"):
        for p in parts:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + p)
    return out
