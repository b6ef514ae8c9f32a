"""Vectorised tokenising and hashing of Arrow string batches.

Every operator of ``countlens.llm`` that needs words works on the UTF-8 bytes
of a whole batch at once: words are byte ranges, and a word's 64-bit hash is a
polynomial over its bytes. Texts are read whole; only the scratch memory is
bounded, by handling about ``PIECE`` bytes at a time and cutting between words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 21

_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_STEP = _U(0xD6E8FEB86659FD93)

_ALL = np.arange(256, dtype=np.uint8)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
#: Bytes of words that white space separates: all but 0x20 and 0x09-0x0D.
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Bytes of words of digits, lower-case letters and anything beyond ASCII.
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of xor-shifts and odd products)."""
    x = x ^ (x >> _U(32))
    x = x * _STEP
    x = x ^ (x >> _U(29))
    x = x * _BASE
    return x ^ (x >> _U(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(_BASE, 64)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(sizes: np.ndarray, limit: int = PIECE) -> list[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a larger row stands alone."""
    out, lo, total = [], 0, 0
    for i, s in enumerate(sizes.tolist()):
        if i > lo and total + s > limit:
            out.append((lo, i))
            lo, total = i, 0
        total += s
    if len(sizes) > lo:
        out.append((lo, len(sizes)))
    return out


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE):
    """The batch in row slices of about ``limit`` text bytes."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for lo, hi in pieces(sizes, limit):
        yield batch.slice(lo, hi - lo)


def word_bounds(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``kind`` bytes that cross no row bound."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = kind[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; the ranges are in order and don't overlap."""
    out = np.empty(len(starts), dtype=_U)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + PIECE)))
        s, e = starts[lo:hi], ends[lo:hi]
        size = e - s
        if int(size.max()) > len(_POWERS):
            for k in np.flatnonzero(size > len(_POWERS)):  # a very long word, by blocks of its bytes
                h = _U(0)
                for j in range(int(s[k]), int(e[k]), PIECE):
                    part = _BYTE[data[j : min(j + PIECE, int(e[k]))]]
                    with np.errstate(over="ignore"):
                        h = h * _STEP + (part * powers(_BASE, len(part))).sum(dtype=_U)
                out[lo + k] = h
            short = np.flatnonzero(size <= len(_POWERS))
        else:
            short = np.arange(hi - lo)
        if len(short):
            s, size = s[short], size[short]
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
            out[lo + short] = np.add.reduceat(_BYTE[data[np.repeat(s, size) + place]] * _POWERS[place], first)
        lo = hi
    return mix(out ^ (ends - starts).astype(_U))


def words(column, kind: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a string column, and the n + 1 offsets of its rows among them."""
    data, at = utf8(column)
    data = LOWER[data] if lower else data
    starts, ends = word_bounds(data, at, kind)
    return hash_ranges(data, starts, ends), np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row, with row offsets.

    A row of fewer words, but not none, gives its whole sequence as one.
    """
    n = np.diff(at)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    out_at = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(out_at[-1]) - np.repeat(out_at[:-1], count) + np.repeat(at[:-1], count)
    length = np.repeat(np.minimum(n, size), count)
    out = np.zeros(len(place), dtype=_U)
    for k in range(size):
        use = length > k
        if use.all():
            out += hashes[place + k] * _POWERS[k]
        else:
            out[use] += hashes[place[use] + k] * _POWERS[k]
    return mix(out ^ length.astype(_U)), out_at


def row_of(at: np.ndarray) -> np.ndarray:
    """The row of each element, from the n + 1 offsets."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))
