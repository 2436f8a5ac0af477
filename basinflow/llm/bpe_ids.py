"""Token ids of a byte-level BPE vocabulary for whole batches of texts.

The vocabulary's split pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

is applied to a batch at once by character class.  Its pieces repeat often, so
the ids of a piece are looked up by hash, and the ``tokenizers`` library is
asked only for pieces that this worker has not met.  A text that holds one of
the vocabulary's added tokens (such as ``<|endoftext|>``) goes to the library
whole, which cuts these out before it splits.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from basinflow.llm import textops as T

# Code points with the Unicode property White_Space.
_WHITE = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
_OTHER, _LETTER, _NUMBER, _WHITE_SPACE = range(4)
CACHE_BITS = 20
POOL_IDS = 8 << 20


def _class(cp: int) -> int:
    if cp in _WHITE:
        return _WHITE_SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(cp))[0], _OTHER)


_ASCII = np.array([_class(c) for c in range(128)] + [_OTHER] * 128, np.uint8)


def _classes(data: np.ndarray) -> np.ndarray:
    """Character class of each byte (all bytes of a code point alike)."""
    cls = _ASCII[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = data[lead].astype(np.int64)
        size = np.where(b >= 0xF0, 4, np.where(b >= 0xE0, 3, 2))
        cp = np.where(size == 4, b & 7, np.where(size == 3, b & 15, b & 31))
        for k in range(1, 4):
            has = size > k
            cp[has] = cp[has] << 6 | data[lead[has] + k] & 63
        uniq, inv = np.unique(cp, return_inverse=True)
        kind = np.array([_class(int(c)) for c in uniq], np.uint8)[inv]
        for k in range(4):
            has = size > k
            cls[lead[has] + k] = kind[has]
    return cls


def split(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the pattern's pieces, in document order."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cls = _classes(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = cls[1:] != cls[:-1]
    edge[offs] = True
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True
    start = edge.copy()
    # White space before something else gives up its last character.
    run = np.flatnonzero(edge)
    s, e = run[:-1], run[1:]
    gives = (cls[s] == _WHITE_SPACE) & ~first[e]
    last = e[gives] - 1
    for _ in range(3):
        last -= (data[last] & 0xC0) == 0x80
    start[last] = True
    start[last[data[last] == 32] + 1] = False
    # An apostrophe alone that opens a piece takes a contraction's letters.
    alone = s[(e - s == 1) & (data[s] == 39) & start[s] & ~first[e]]
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    room = offs[np.searchsorted(offs, alone, "right")] - alone
    x, y = padded[alone + 1], padded[alone + 2]
    size = np.zeros(len(alone), np.int64)
    for ending in (b"re", b"ve", b"ll"):
        size[(x == ending[0]) & (y == ending[1]) & (room > 2)] = 3
    for ending in b"stmd":
        size[x == ending] = 2
    at, size = alone[size > 0], size[size > 0]
    start[at + 1] = False
    rest = at + size
    inner = ~first[rest]
    rest = rest[inner]
    start[rest[cls[np.minimum(rest, len(cls) - 1)] == _LETTER]] = True
    bounds = np.flatnonzero(start)
    return bounds[:-1], bounds[1:]


class Encoder:
    """Ids of each document of a batch; one a worker, kept between batches."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # Spark's tasks share the cores
        from tokenizers import Tokenizer
        self.bpe = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.bpe.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self):
        n = 1 << CACHE_BITS
        self.key, self.at, self.size = np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [x.ids for x in self.bpe.encode_batch(pieces, add_special_tokens=False)]
        size = np.array([len(g) for g in got], np.int64)
        flat = np.array([i for g in got for i in g], np.int32)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        return at, size

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch, and how many each document has."""
        ids, n = self._encode(data, offs)
        raw = data.tobytes()
        if not any(t in raw for t in self.added):
            return ids, n
        each = np.split(ids, np.cumsum(n)[:-1])
        for k, (i, j) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
            if any(t in raw[i:j] for t in self.added):
                each[k] = np.array(self.bpe.encode(raw[i:j].decode(), add_special_tokens=False).ids, np.int32)
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def _encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.used > POOL_IDS:
            self._clear()
        s, e = split(data, offs)
        h = T.hash_spans(data, s, e)
        slot = (h >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        at, size = self.at[slot], self.size[slot]
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            _, one, inv = np.unique(h[miss], return_index=True, return_inverse=True)
            raw = data.tobytes()
            new = miss[one]
            a, n = self._learn([raw[i:j].decode() for i, j in zip(s[new].tolist(), e[new].tolist(), strict=True)])
            at[miss], size[miss] = a[inv], n[inv]
            self.key[slot[new]], self.at[slot[new]], self.size[slot[new]] = h[new], a, n
        ends = np.cumsum(size)
        ids = self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - size), size)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(s, offs)]
        return ids, np.diff(bounds)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
