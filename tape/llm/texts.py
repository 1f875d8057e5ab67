"""Vectorised work on the UTF-8 bytes of Arrow text columns (numpy, no
per-character Python).  Used inside ``mapInArrow`` functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is handled alone.
CHUNK_BYTES = 1 << 20

#: The separators of ``[^\x20\x09-\x0D]+`` words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64


def text_bytes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of rows, row is not null) of an Arrow string column."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        valid = np.asarray(arr.is_valid())
        arr = arr.fill_null("")
    else:
        valid = np.ones(len(arr), bool)
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, np.int64, count=len(arr) + 1, offset=arr.offset * 8) if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offs, valid


def chunks(column, most: int = CHUNK_BYTES):
    """Yield (first row, last row + 1, bytes, offsets from 0) in blocks of at
    most ``most`` bytes, or of one row."""
    data, offs, _ = text_bytes(column)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of the first run of each row and of the end) of the
    runs of True that stay within a row."""
    n = len(inside)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    cut = offs[offs < n]
    before[cut] = False
    cut = offs[offs > 0] - 1
    after[cut] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def segment_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i+1]]``; empty segments give 0."""
    total = np.zeros((len(values) + 1,) + values.shape[1:], values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> _U(30))
        h = h * _U(0xBF58476D1CE4E5B9)
        h = h ^ (h >> _U(27))
        h = h * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


#: One 64-bit value for each byte, and the multiplier of a place in a word.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
PLACE = _U(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(int(lengths.max()), PLACE)]))
        values = BYTE_VALUES[data[np.repeat(starts, lengths) + at]] * power[at]
        h = np.add.reduceat(values, np.cumsum(lengths) - lengths)
        return mix(h + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds of rows) of the ``size``-word shingles of each row, in
    order, with repeats.  A row of fewer words, but not none, has one shingle:
    all of its words."""
    counts = np.diff(first)
    n_sh = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate([[0], np.cumsum(n_sh)])
    with np.errstate(over="ignore"):
        mult = [mix(np.array([k + 101], np.uint64))[0] | _U(1) for k in range(size)]
        out = np.zeros(int(bounds[-1]), np.uint64)
        row = np.repeat(np.arange(len(counts)), n_sh)
        at = first[:-1][row] + (np.arange(len(out)) - bounds[:-1][row])
        room = first[1:][row]
        for k in range(size):
            ok = at + k < room
            out[ok] += mix(words[(at + k)[ok]] + _U(k)) * mult[k]
        out += np.minimum(counts[row], size).astype(np.uint64)
    return mix(out), bounds
