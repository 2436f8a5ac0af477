"""Array helpers over a batch of texts: words, 64-bit hashes, n-grams.

A batch is one contiguous UTF-8 byte array plus document offsets, taken from
Arrow without copying, so the helpers never build a Python string per word.
Words are the maximal runs outside the ASCII white space 0x20, 0x09-0x0D;
UTF-8 multi-byte sequences hold none of those bytes, so byte and code point
views agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Odd multipliers of the 64-bit finaliser and of the n-gram polynomial (the
# latter is 3 mod 4, so swapping two words always changes the sum).
_M1, _M2, _M3 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C17))
_POLY = np.uint64(0xD6E8FEB86659FD93)
_S33 = np.uint64(33)
LONG_WORD = 1024
SLICE_BYTES = 4 << 20


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit (bijective)."""
    h = h ^ (h >> _S33)
    h *= _M1
    h ^= h >> _S33
    h *= _M2
    h ^= h >> _S33
    return h


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most ``limit`` bytes (always one row at least)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def text_slices(col, limit: int = SLICE_BYTES):
    """(first row, last row, bytes, offsets) of each slice of a text column."""
    data, offs = text_buffers(col)
    for i, j in slices(offs, limit):
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offs: np.ndarray):
    """Word starts, ends, and per document the range of its words."""
    inside = ~_SPACE[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = offs[1:] > offs[:-1]
    first, last = offs[:-1][full], offs[1:][full] - 1
    start[first] = inside[first]
    end[last] = inside[last]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offs)


def hash_spans(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time."""
    n = e - s
    h = (n.astype(np.uint64) + np.uint64(1)) * _M3
    if not len(s):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lane = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    live, at, left = np.arange(len(s)), s, n
    big = np.flatnonzero(n > LONG_WORD)
    if len(big):
        for k in big:
            h[k] = int.from_bytes(hashlib.blake2b(data[s[k]:e[k]].tobytes(), digest_size=8).digest(), "little")
        live = np.flatnonzero(n <= LONG_WORD)
        at, left = s[live], n[live]
    while len(live):
        x = lane[at].astype(np.uint64)
        short = left < 8
        x[short] &= (np.uint64(1) << (left[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
        h[live] = mix64((h[live] ^ x) * _M3)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def ngrams(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries of ``w``."""
    if len(w) < k:
        return np.zeros(0, np.uint64)
    m = len(w) - k + 1
    g = w[:m].copy()
    for i in range(1, k):
        g *= _POLY
        g += w[i:i + m]
    return mix64(g)


def rows_of(counts: np.ndarray) -> np.ndarray:
    """Row number of each entry, from the number of entries of each row."""
    return np.repeat(np.arange(len(counts)), counts)


def ngram_index(first: np.ndarray, k: int):
    """Positions (in the batch's words) where a k-gram of one document starts,
    and how many each document has."""
    n = np.diff(first)
    per = np.maximum(n - k + 1, 0)
    row = rows_of(per)
    at = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + first[:-1][row]
    return at, per


def spread(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive entries: ``counts[i]`` of them for row i."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def code_points(data: np.ndarray) -> np.ndarray:
    """True at each byte that begins a code point."""
    return (data & 0xC0) != 0x80
