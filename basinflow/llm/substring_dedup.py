"""Substring dedup by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of BLOCK words;
all rolling windows of BLOCK words probe them.  A repeat of LENGTH words holds
a whole reference block of either document (2 * BLOCK - 1 <= LENGTH), so each
repeat has an anchor.  The live anchors, blocks that occur again anywhere, are
extended: every LENGTH-word window over one is compared with all others by its
hash, and the adjoining repeated windows merge into maximal repeats.  A window
goes if its words also start in a document with a smaller id; a hit group keeps
only its smallest id, so a passage in any number of documents makes no pairs.

Windows are told apart by 64-bit hashes.  Defined results: null and empty
texts have no words; a null id counts as smaller than any other; documents of
equal id are not copies of each other's windows; shorter documents than LENGTH
words keep all words.  Each row gives one row.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basinflow.llm import exchange as X
from basinflow.llm import textops as T

LENGTH = 13
BLOCK = (LENGTH + 1) // 2
_LOW = np.uint64(0xFFFFFFFF)


class _Words:
    def __init__(self, b: X.Batch):
        self.s, self.e, self.first = T.words(b.data, b.offs)
        self.n = np.diff(self.first)
        self.h = T.hash_spans(b.data, self.s, self.e)


def _probes(w: _Words, block: int, buckets: int):
    """(position, sorted distinct keys, key number of each position, code):
    key = bucket, code, lower hash half; the code tells whether a reference
    block of this chunk has the hash (1) and whether it occurs twice here (2)."""
    at, per = T.ngram_index(w.first, block)
    g = T.ngrams(w.h, block)[at] if len(at) else np.zeros(0, np.uint64)
    key = X.bucket_of(g, buckets) << np.uint64(32) | g & _LOW
    aligned = (at - w.first[:-1][T.rows_of(per)]) % block == 0
    distinct, inv, count = np.unique(key, return_inverse=True, return_counts=True)
    code = (count > 1).astype(np.uint64) * np.uint64(2)
    code[inv[aligned]] |= np.uint64(1)
    full = (distinct >> np.uint64(32)) << np.uint64(34) | code << np.uint64(32) | distinct & _LOW
    order = np.argsort(full)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return at, full[order], rank[inv]


def _ask_blocks(block: int, buckets: int):
    def questions(b: X.Batch):
        _, full, _ = _probes(_Words(b), block, buckets)
        code = (full >> np.uint64(32)) & np.uint64(3)
        for k, i, j in X.by_bucket(full >> np.uint64(34)):
            head = np.bincount(code[i:j].astype(np.int64), minlength=4).astype("<u4")
            yield k, head.tobytes() + full[i:j].astype("<u4").tobytes()
    return questions


def _live_blocks(blobs: list[bytes]) -> list[bytes]:
    """One bit a hash: is it a reference block that occurs twice or more?"""
    heads = [np.frombuffer(x, "<u4", 4) for x in blobs]
    hashes = [np.frombuffer(x, "<u4", offset=16) for x in blobs]
    codes = np.concatenate([np.repeat(np.arange(4, dtype=np.int64), h) for h in heads])
    distinct, inv = np.unique(np.concatenate(hashes), return_inverse=True)
    times = np.bincount(inv, 1 + (codes >> 1), len(distinct))
    block = np.zeros(len(distinct), bool)
    block[inv[(codes & 1) == 1]] = True
    live = (block & (times > 1))[inv]
    ends = np.cumsum([len(h) for h in hashes])
    return [np.packbits(part).tobytes() for part in np.split(live, ends[:-1])]


def _bits(full_bucket: np.ndarray, replies: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(len(full_bucket), bool)
    for k, i, j in X.by_bucket(full_bucket):
        out[i:j] = np.unpackbits(np.frombuffer(replies[k], np.uint8), count=j - i).astype(bool)
    return out


def _windows_over(w: _Words, live_at: np.ndarray, length: int, block: int) -> np.ndarray:
    """Starts of the windows of one document that hold a live anchor."""
    mark = np.zeros(len(w.s) + 1, np.int64)
    mark[live_at + 1] = 1
    total = np.cumsum(mark)
    at, _ = T.ngram_index(w.first, length)
    return at[total[at + length - block + 1] > total[at]]


def _first_owner(hashes: np.ndarray, ids: np.ndarray):
    """Distinct hashes with the smallest id of each, and each entry's number."""
    distinct, inv = np.unique(hashes, return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, inv, ids)
    return distinct, least, inv


def _window_hashes(b: X.Batch, w: _Words, at: np.ndarray, length: int):
    g = T.ngrams(w.h, length)
    h = g[at] if len(at) else np.zeros(0, np.uint64)
    return h, b.id[np.searchsorted(w.first, at, "right") - 1]


def _order(distinct: np.ndarray, buckets: int):
    bucket = X.bucket_of(distinct, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _ask_windows(length: int, block: int, buckets: int):
    """Extend the live anchors: the chunk's candidate windows and their first
    owners here; the candidates' places stay with the chunk as a note."""
    def use(b: X.Batch, replies: dict[int, bytes]) -> pa.Table:
        w = _Words(b)
        at, full, number = _probes(w, block, buckets)
        live = _bits(full >> np.uint64(34), replies)
        cand = _windows_over(w, at[live[number]], length, block)
        h, ids = _window_hashes(b, w, cand, length)
        distinct, least, _ = _first_owner(h, ids)
        order, bucket = _order(distinct, buckets)
        mask = np.zeros(len(w.s), bool)
        mask[cand] = True
        rows = [(X.note(b.chunk), zlib.compress(np.packbits(mask).tobytes(), 1))]
        for k, i, j in X.by_bucket(bucket):
            part = order[i:j]
            rows.append((k, distinct[part].astype("<u8").tobytes() + least[part].astype("<i8").tobytes()))
        return X._rows(b.chunk, rows)
    return use


def _foreign_owner(blobs: list[bytes]) -> list[bytes]:
    """One bit a window: does another chunk hold it under a smaller id?"""
    n = [len(x) // 16 for x in blobs]
    hashes = np.concatenate([np.frombuffer(x, "<u8", k) for x, k in zip(blobs, n, strict=True)])
    ids = np.concatenate([np.frombuffer(x, "<i8", offset=8 * k) for x, k in zip(blobs, n, strict=True)])
    _, least, inv = _first_owner(hashes, ids)
    return [np.packbits(part).tobytes() for part in np.split(least[inv] < ids, np.cumsum(n)[:-1])]


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>, kept string"


def _remove(length: int, buckets: int, keep_text: bool):
    def use(b: X.Batch, replies: dict[int, bytes]) -> pa.Table:
        w = _Words(b)
        mask = np.unpackbits(np.frombuffer(zlib.decompress(replies[X.note(b.chunk)]), np.uint8), count=len(w.s))
        cand = np.flatnonzero(mask)
        h, ids = _window_hashes(b, w, cand, length)
        distinct, least, inv = _first_owner(h, ids)
        order, bucket = _order(distinct, buckets)
        foreign = np.zeros(len(distinct), bool)
        foreign[order] = _bits(bucket, replies)
        gone = np.zeros(len(w.s), bool)
        hit = cand[foreign[inv] | (ids > least[inv])]
        for k in range(length):
            gone[hit + k] = True
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
        raw, sha, text, spans = b.data.tobytes(), [], [], []
        for i in range(len(w.n)):
            parts = raw[b.offs[i]:b.offs[i + 1]].split()
            if removed[i]:
                g = gone[w.first[i]:w.first[i + 1]]
                parts = compress(parts, ~g)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]])))
                spans.append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
            else:
                spans.append([])
            kept = b" ".join(parts)
            sha.append(hashlib.sha256(kept).hexdigest())
            text.append(kept.decode() if keep_text else None)
        return pa.table({
            "doc_id": b.ids, "n_words": pa.array(w.n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": sha, "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            "kept": pa.array(text, pa.string())})
    return use


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col="doc_id", text_col="text", keep_text=True,
                   **sizes) -> DataFrame:
    """One row per document: word counts, the maximal removed word spans, and
    (``keep_text``) the kept words joined by one space."""
    block = (length + 1) // 2
    c = X.chunked(docs, id_col, text_col, **sizes)
    live = X.answer(c.ask(_ask_blocks(block, c.buckets)), _live_blocks)
    owners = X.answer(c.with_answers(live, _ask_windows(length, block, c.buckets), X.ROWS), _foreign_owner)
    return c.with_answers(owners, _remove(length, c.buckets, keep_text), RESULT)
