"""Phrase collocations by stripes.

A stripe is one prefix's associative counter of next words.  Texts are cut at
punctuation and line ends into pieces; each word occurrence adds one to the
stripe of the empty prefix, and, with the two words after it (or the end of
the piece), one to the stripe of its two-word prefix.  A task merges the
stripes of a bounded buffer, codes their words by a local dictionary and sends
them to a bucket of the prefix (the empty prefix's by next word); a bucket
merges stripes element by element.  From the merged stripes come, at once, the
extensions (words, three-word phrases), the prefix totals (all words, two-word
phrases) and the largest extension of each prefix.

So a word or word pair that a third of all rows hold arrives as one stripe a
buffer, and no stripe is longer than the vocabulary.

Scores are exact integers (decimals of 38 digits, which hold 10**6 times the
square of any count below 10**15).  Words are told apart by a 64-bit hash while
stripes are merged.

Defined results: a null text is empty, a null language is 'und'; repeated rows
count as often as they occur; ids are not read, nor other columns; an empty
table, or one without a phrase that is frequent enough, gives no row.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinflow.llm import exchange as X
from basinflow.llm import textops as T
from basinflow.llm.store import batch_rows, cut

MIN_COUNT = 10
SUBSUMED = 50               # per cent of a phrase inside one longer phrase
TOP = 2000
SCALE = 1_000_000
BUFFER_BYTES = 8 << 20     # text whose stripes a task merges before it sends them
BUCKET_BYTES = 6 << 20      # text that a bucket answers for, on average
END = np.uint64(0)          # the next "word" at the end of a piece
_PAIR = np.uint64(0x9E3779B97F4A7C15)

# What ends a piece, and what only parts words.
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _ENDS.copy()
_APART[list(b"\x20\x09")] = True


def pieces(data: np.ndarray, offs: np.ndarray):
    """Starts and ends of words, and how many words are left in the piece from
    each word on (itself included)."""
    inside = ~_APART[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    if not len(s):
        return s, e, np.zeros(0, np.int64)
    # A word is its piece's last if an end or another text lies before the next.
    parts = np.sort(np.concatenate([np.flatnonzero(_ENDS[data]), offs[1:-1]]))
    last = np.concatenate([np.searchsorted(parts, s[1:], "right") > np.searchsorted(parts, e[:-1]), [True]])
    stop = np.flatnonzero(last)
    return s, e, stop[np.searchsorted(stop, np.arange(len(s)))] - np.arange(len(s)) + 1


def _grouped(codes: np.ndarray, size: int):
    """An order that brings equal columns of ``codes`` (3, n), all below
    ``size``, together, and where in it each run of equal ones begins."""
    if size < 1 << 21:
        packed = (codes[0] * size + codes[1]) * size + codes[2]
        order = np.argsort(packed, kind="stable")
        packed = packed[order]
        return order, np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    order = np.lexsort(codes[::-1])
    held = codes[:, order]
    return order, np.flatnonzero(np.concatenate([[True], (held[:, 1:] != held[:, :-1]).any(0)]))


def _narrow(x: np.ndarray) -> bytes:
    """An array by its smallest unsigned type: size in bytes, then values."""
    top = int(x.max()) if len(x) else 0
    size = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return size.to_bytes(1, "little") + _planes(x.astype(f"<u{size}"))


def _widen(b: memoryview, n: int):
    size = b[0]
    return _unplanes(b[1:], n, size).astype(np.int64), b[1 + size * n:]


def _runs(bucket: np.ndarray):
    """(bucket, first, last) of each run of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
        yield int(bucket[i]), i, j


def _row(lang, kind: int, bucket: int, blob: bytes):
    return lang, kind, bucket, pa.compress(blob, "zstd", asbytes=True), len(blob)


def _send_words(lang, hashes, words, times, buckets: int):
    """The empty prefix's stripe, by buckets of the next word."""
    bucket = X.bucket_of(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    for k, i, j in _runs(bucket[order]):
        part = order[i:j]
        yield _row(lang, 1, k, np.array([j - i], "<i8").tobytes() + _planes(hashes[part].astype("<u8")) + _narrow(times[part])
                   + b"\n".join([words[x] for x in part.tolist()]))


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal place side by side: sorted values compress well so."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(b, n: int, size: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8, n * size).reshape(size, n).T).view(f"<u{size}").ravel()


def _read_words(blob, size: int):
    b = memoryview(pa.decompress(blob, size, "zstd", asbytes=True))
    n = int(np.frombuffer(b, "<i8", 1)[0])
    times, rest = _widen(b[8 + 8 * n:], n)
    return _unplanes(b[8:], n, 8), times, bytes(rest).split(b"\n")


def _send_stripes(lang, hashes: np.ndarray, codes: np.ndarray, times: np.ndarray, buckets: int):
    """Stripes of two-word prefixes; ``codes`` (3, n) index ``hashes``, the
    first of which is the end."""
    bucket = X.bucket_of(T.mix64(hashes[codes[0]] * _PAIR ^ hashes[codes[1]]), buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, codes, times = bucket[order], codes[:, order], times[order]
    for k, i, j in _runs(bucket):
        used, inv = np.unique(np.concatenate([[0], codes[:, i:j].ravel()]), return_inverse=True)     # the end is always 0
        head = np.array([len(used), j - i], "<i8").tobytes() + _planes(hashes[used[1:]].astype("<u8"))
        one, two, three = inv[1:].reshape(3, -1)                    # first words ascend
        yield _row(lang, 2, k, head + b"".join(_narrow(x) for x in (np.diff(one, prepend=0), two, three, times[i:j])))


def _read_stripes(blob, size: int):
    b = memoryview(pa.decompress(blob, size, "zstd", asbytes=True))
    m, n = np.frombuffer(b, "<i8", 2).tolist()
    hashes, b, cols = np.concatenate([[END], _unplanes(b[16:], m - 1, 8)]), b[16 + 8 * (m - 1):], []
    for _ in range(4):
        x, b = _widen(b, n)
        cols.append(x)
    cols[0] = np.cumsum(cols[0])
    return hashes, np.stack(cols[:3]), cols[3]


def _stripes(lang, texts: list[tuple[np.ndarray, np.ndarray]], buckets: int):
    """Merged stripes of one language's buffer, as rows to send."""
    data = T.lower_ascii(np.concatenate([d for d, _ in texts]))
    base = np.cumsum([0] + [len(d) for d, _ in texts])
    offs = np.concatenate([[0], *[o[1:] + b for (_, o), b in zip(texts, base, strict=False)]])
    s, e, left = pieces(data, offs)
    n = len(s)
    if not n:
        return
    h = T.hash_spans(data, s, e)
    h[h == END] = np.uint64(1)
    hashes, one, code = np.unique(h, return_index=True, return_inverse=True)
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(s[one].tolist(), e[one].tolist(), strict=True)]
    yield from _send_words(lang, hashes, words, np.bincount(code, minlength=len(hashes)), buckets)
    code = np.concatenate([code + 1, [0, 0]])
    codes = np.stack([code[:n], np.where(left > 1, code[1:n + 1], 0), np.where(left > 2, code[2:n + 2], 0)])
    del data, raw, h, s, e, words, one, code, left
    order, first = _grouped(codes, len(hashes) + 1)
    codes = codes[:, order[first]]
    del order
    yield from _send_stripes(lang, np.concatenate([[END], hashes]), codes, np.diff(first, append=n), buckets)


SENT = "lang string, kind int, bucket int, blob binary, size long"
MERGED = "kind int, w1 long, w2 long, w3 long, word string, f long, total long, widest long"


def _scan(buckets: int, buffer_bytes: int):
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.int64())

    def flush(lang, held):
        for some in itertools.batched(_stripes(lang, held, buckets), 64):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some, strict=True), kinds, strict=True)],
                                             ["lang", "kind", "bucket", "blob", "size"])

    def run(batches):
        held, size = {}, {}
        for b in batches:
            langs = b.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                rows = pa.array(np.flatnonzero([x == lang for x in langs]))
                for _, _, data, offs in T.text_slices(b.column("text").take(rows)):
                    held.setdefault(lang, []).append((data.copy(), offs))
                    size[lang] = size.get(lang, 0) + len(data)
                if size.get(lang, 0) > buffer_bytes:
                    yield from flush(lang, held.pop(lang))
                    size.pop(lang)
            if sum(size.values()) > 4 * buffer_bytes:
                for lang in sorted(held):
                    yield from flush(lang, held[lang])
                held, size = {}, {}
        for lang in sorted(held):
            yield from flush(lang, held[lang])
    return run


def _facts(lang, n: int, **cols) -> pa.Table:
    """Rows of ``MERGED``; a column that is not given is 0 or no word."""
    out = {"lang": pa.array([lang] * n, pa.string())}
    for c in MERGED.split(", "):
        name, kind = c.split()
        t = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind]
        x = cols.get(name)
        out[name] = pa.nulls(n, t) if x is None else x if isinstance(x, pa.Array) else pa.array(x).cast(t)
    return pa.table(out)


def _merge_words(lang, parts, min_count: int) -> pa.Table:
    """Kind 0: how many words there are; kind 1: frequent words."""
    hashes, one, inv = np.unique(np.concatenate([h for h, _, _ in parts]), return_index=True, return_inverse=True)
    f = np.bincount(inv, np.concatenate([t for _, t, _ in parts])).astype(np.int64)
    often = np.flatnonzero(f >= min_count)
    base = np.cumsum([0] + [len(h) for h, _, _ in parts])
    words = [None]
    for x in one[often].tolist():
        k = int(np.searchsorted(base, x, "right")) - 1
        words.append(parts[k][2][x - base[k]])
    return _facts(lang, len(often) + 1, kind=np.repeat([0, 1], [1, len(often)]),
                  w1=np.concatenate([[0], hashes[often].view(np.int64)]), word=pa.array(words, pa.binary()).cast(pa.string()),
                  f=np.concatenate([[f.sum()], f[often]]))


def _merge_stripes(lang, parts, min_count: int) -> pa.Table:
    """Kind 2: frequent prefixes with their largest frequent extension; kind
    3: frequent extensions with the total of their prefix."""
    hashes = np.unique(np.concatenate([h for h, _, _ in parts]))        # hashes[0] is the end
    codes = np.concatenate([np.searchsorted(hashes, h)[c] for h, c, _ in parts], 1)
    order, first = _grouped(codes, len(hashes))
    f = np.add.reduceat(np.concatenate([t for *_, t in parts])[order], first)
    codes = codes[:, order[first]]
    at = np.flatnonzero(np.concatenate([[True], (codes[:2, 1:] != codes[:2, :-1]).any(0)]))
    total = np.add.reduceat(f, at)
    ext = (f >= min_count) & (codes[2] > 0)
    widest = np.maximum.reduceat(np.where(ext, f, 0), at)
    prefix = np.repeat(np.arange(len(at)), np.diff(at, append=len(f)))
    ext, pre = np.flatnonzero(ext), np.flatnonzero((total >= min_count) & (codes[1][at] > 0))
    w = hashes.view(np.int64)[np.concatenate([codes[:, at[pre]], codes[:, ext]], 1)]
    return _facts(lang, len(pre) + len(ext), kind=np.repeat([2, 3], [len(pre), len(ext)]), w1=w[0], w2=w[1], w3=w[2],
                  f=np.concatenate([total[pre], f[ext]]), total=np.concatenate([total[pre], total[prefix[ext]]]),
                  widest=np.concatenate([widest[pre], np.zeros(len(ext), np.int64)]))


def _merge(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        read, merge = ((_read_words, _merge_words), (_read_stripes, _merge_stripes))[table.column("kind")[0].as_py() - 1]
        blobs = zip(table.column("blob").to_pylist(), table.column("size").to_pylist(), strict=True)
        return merge(table.column("lang")[0].as_py(), [read(b, n) for b, n in blobs], min_count)
    return run


def stripes(docs: DataFrame, text_col="text", lang_col="lang", min_count=MIN_COUNT,
            buffer_bytes=BUFFER_BYTES, bucket_bytes=BUCKET_BYTES) -> DataFrame:
    """The merged stripes' facts (``MERGED`` with ``lang``), written once."""
    batch_rows(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(total / bucket_bytes))
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sent = rows.mapInArrow(_scan(buckets, buffer_bytes), SENT).repartition(2 * buckets, "lang", "kind", "bucket")
    return cut(sent.groupBy("lang", "kind", "bucket").applyInArrow(_merge(min_count), f"lang string, {MERGED}"), "stripes")


def _exact(x: Column) -> Column:
    return x.cast("decimal(18,0)")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), in exact decimals."""
    up = (_exact(a) * _exact(a) * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)")
    down = (_exact(left) * _exact(right)).cast("decimal(38,0)")
    return F.call_function("div", up, down)


def phrases(merged: DataFrame, subsumed: int = SUBSUMED) -> DataFrame:
    """Scored phrases that no longer phrase subsumes: lang, phrase, a, l, r, n, score."""
    totals = merged.where("kind = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    words = merged.where("kind = 1")
    pairs = merged.where("kind = 2").select("lang", "w1", "w2", "f", "widest")
    triples = merged.where("kind = 3").select("lang", "w1", "w2", "w3", "f", "total")

    def word(k):
        """The word behind a hash; every word of a frequent phrase is frequent."""
        return words.select("lang", F.col("w1").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}"))

    # The largest three-word phrase that ends in a pair.
    ended = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("f").alias("ended"))
    two = (pairs.join(ended, ["lang", "w1", "w2"], "left")
           .where(F.greatest("widest", F.coalesce("ended", F.lit(0))) * 100 < F.col("f") * subsumed)
           .join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"])
           .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"),
                   F.col("f2").alias("r"), _score(F.col("f"), F.col("f1"), F.col("f2")).alias("score")))
    tails = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("tail"))
    three = triples.join(tails, ["lang", "w2", "w3"])
    for k in (1, 2, 3):
        three = three.join(word(k), ["lang", f"w{k}"])
    three = three.withColumns({"s1": _score(F.col("f"), F.col("f1"), F.col("tail")), "s2": _score(F.col("f"), F.col("total"), F.col("f3"))})
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), F.col("f").alias("a"),
                         F.when(early, F.col("f1")).otherwise(F.col("total")).alias("l"),
                         F.when(early, F.col("tail")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    return two.unionByName(three).join(totals, "lang")


def mine(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, subsumed: int = SUBSUMED, **options) -> DataFrame:
    """The first ``top`` phrases of each language by score.  Shares of a
    language's phrases are cut to ``top`` before they meet in its one task."""
    def first(found, *keys):
        order = Window.partitionBy("lang", *keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    found = phrases(stripes(docs, min_count=min_count, **options), subsumed)
    shares = 3 * docs.sparkSession.sparkContext.defaultParallelism
    found = first(found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares))), "share")
    return first(found).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                               F.col("score").cast("long").alias("score"))
