"""Vectorised words and shingles of a batch of texts, as 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes with A-Z lower-cased. A word's hash is a
polynomial over its bytes modulo 2**64, taken from running sums, so a batch needs no loop over
words. Batches are cut to pieces of a MB and sums run over 128 KB, so a worker needs little memory besides its
batch, and a very long text costs memory in proportion to itself only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SUMS = 1 << 17
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and UTF-8 bytes of a text column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def slices(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _upto(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * SUMS)
        _powers[:] = [
            np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]).cumprod(dtype=np.uint64)
            for base in (_BASE, _INVERSE)
        ]
    return _powers


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of ``values``, from running sums over stretches of the batch."""
    out = np.empty(len(starts), np.uint64)
    groups = np.flatnonzero(np.diff(starts // SUMS)) + 1
    for i, j in zip([0, *groups], [*groups, len(starts)]):
        if i == j:
            continue
        lo, hi = starts[i], ends[j - 1]
        up, down = _upto(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[lo:hi] * up[: hi - lo], dtype=np.uint64, out=sums[1:])
        out[i:j] = (sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * down[starts[i:j] - lo]
    return mix(out)


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each row."""
    n = len(data)
    rows = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    inside = ~_GAP[data]
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    cuts = offsets[1:-1]
    before[cuts[cuts < n]] = False
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    counts = np.searchsorted(starts, offsets[1:], "left") - np.searchsorted(starts, offsets[:-1], "left")
    return span_hashes(_BYTE[data], starts, ends), counts


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each row, sorted, one row after the other, and their numbers.

    A row of fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    rows = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    n = max(0, len(hashes) - k + 1)
    whole = np.zeros(n, np.uint64)
    for j in range(k):
        whole += hashes[j : j + n] * _PLACE[j]
    valid = np.arange(n) + k <= ends[rows[:n]]
    whole, of = mix(whole[valid]), rows[:n][valid]
    short = np.flatnonzero((counts > 0) & (counts < k))
    extra = [
        mix((hashes[ends[r] - counts[r] : ends[r]] * _PLACE[k : k + counts[r]]).sum(dtype=np.uint64, keepdims=True))
        for r in short
    ]
    if len(short):
        whole, of = np.concatenate([whole, *extra]), np.concatenate([of, short])
    order = np.lexsort((whole, of))
    whole, of = whole[order], of[order]
    first = np.ones(len(whole), bool)
    first[1:] = (whole[1:] != whole[:-1]) | (of[1:] != of[:-1])
    whole, of = whole[first], of[first]
    return whole, np.bincount(of, minlength=len(counts))


def row_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, shingles and their numbers for pieces of a text column."""
    offsets, data = text_bytes(column)
    for i, j in slices(offsets):
        own = offsets[i : j + 1] - offsets[i]
        yield i, j, *shingle_sets(*words(own, data[offsets[i] : offsets[j]]), k)
