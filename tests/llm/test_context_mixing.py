"""Context mixing: a proper distribution, the base's counts, edge cases."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basinflow.llm import context_mixing as C
from basinflow.llm import textops as T
from basinflow.llm.queries import QUERIES, _is_training
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\0end "]


def test_base_and_held_out_scores(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_context_mixing"][0](spark, SF).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    count = Counter(w for d, t in docs.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in words(t))
    n, v = sum(count.values()), len(count)
    assert got.keys() == docs.keys()
    for d, t in docs.items():
        r, w = got[d], words(t)
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 7 == 2)
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(w), n, sum(count[x] > 0 for x in w))
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
    held = [r for r in got.values() if r["held_out"]]
    assert np.mean([r["bits_per_byte"] for r in held]) < 3.5


def known(texts_of_chunks, code=None, often=None):
    """Each chunk's codes with their answers, as the buckets give them."""
    asked, notes = [], []
    for texts in texts_of_chunks:
        data, offs = T.text_buffers(pa.array(texts))
        c, n = np.unique(C.contexts(data, offs)[0], return_counts=True) if code is None else (code, often)
        notes.append(C._packed(C._planes(c) + C._planes(n.astype("<u4"))))
        asked.append(dict(C._ask_codes(c, n.astype("<u4"), 3)))
    replies = [{} for _ in asked]
    for bucket in range(3):
        who = [k for k, a in enumerate(asked) if bucket in a]
        for k, reply in zip(who, C._code_counts([asked[k][bucket] for k in who]) if who else [], strict=True):
            replies[k][bucket] = reply
    return [C.Known(n, b"".join(r[k] for k in sorted(r)), [len(r[k]) for k in sorted(r)], 3) for n, r in zip(notes, replies, strict=True)]


def test_probabilities_of_all_symbols_add_up_to_one():
    for context in (0, 0x7468, 0x20746865):
        code = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        k = known([[]], code, np.arange(256) % 7)[0]
        assert (2.0 ** C.single(C.start()).log2_codes(code, k.full)).sum() == pytest.approx(1.0, rel=1e-5)


def plain_bits(texts, training):
    """-log2 of each text's probability by the unlearned mixer, bit by bit."""
    reach, unit, cells = max(C.ORDERS), C.UNIT, C.MAP_CELLS
    seen = Counter()

    def steps(text):
        data = bytes(reach) + text.lower().encode() + b"\0"
        for at in range(reach, len(data)):
            for bit in range(8):
                known_bits = (1 << bit) | data[at] >> 8 - bit
                yield [(o, data[at - o:at], known_bits) for o in C.ORDERS], data[at] >> 7 - bit & 1

    for t, used in zip(texts, training, strict=True):
        if used:
            seen.update((c, one) for found, one in steps(t) for c in found)
    out = []
    for t in texts:
        total = 0.0
        for found, one in steps(t):
            z = 0.0
            for c in found:
                odds = math.log((seen[c, 1] + 0.4) / (seen[c, 0] + 0.4))
                z += 0.3 / unit * max(-127, min(127, round(odds * unit)))
            z = max(-C.MAP_REACH + 1e-3, min(C.MAP_REACH - 1e-3, z))
            place = (z + C.MAP_REACH) * (cells - 1) / (2 * C.MAP_REACH)
            line = [1 / (1 + math.exp(C.MAP_REACH - 2 * C.MAP_REACH * (int(place) + k) / (cells - 1))) for k in (0, 1)]
            p = (line[0] + (line[1] - line[0]) * (place - int(place)) + 1 / (1 + math.exp(-z))) / 2
            p = max(C.LEAST_P, min(1 - C.LEAST_P, p))
            total -= math.log2(p if one else 1 - p)
        out.append(total)
    return out


def test_score_against_plain_python(spark, monkeypatch):
    """Counts, contexts that one chunk or several hold, mixing and map, with
    the weights that learning starts from."""
    r = np.random.default_rng(8)
    texts = ["the cat sat on the mat", "The dog sat", "", "é中"] + ["".join(r.choice(list("abc "), 60)) for _ in range(30)]
    texts += [f"only {k} here: {k * 7919}" for k in range(10)]
    monkeypatch.setattr(C, "fit", lambda gathered, buckets: C.single(C.start()))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    training = [i % 3 != 0 for i in range(len(texts))]
    out = C.score(docs, F.col("doc_id") % 3 != 0, lambda ids: ids % 3 != 0, chunk_bytes=300, bucket_bytes=700).collect()
    assert len({x["train_tokens"] for x in out}) == 1
    for x, want in zip(sorted(out, key=lambda x: x["doc_id"]), plain_bits(texts, training), strict=True):
        assert x["bits"] == pytest.approx(want, rel=1e-4, abs=1e-3)
        assert x["score"] == pytest.approx(-want * math.log10(2), rel=1e-4, abs=1e-3)


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Some Words here", "x"), (3, "Some Words here", "x"), (None, "no id", "x"),
            (9, "long " * 40_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, bits string")
    out = C.score(df, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True)), _is_training).collect()
    assert len(out) == len(rows)
    same = [r["score"] for r in out if r["doc_id"] == 3]
    assert same[0] == same[1] and all(r["score"] < 0 for r in out)
    none = C.score(df, F.lit(False), lambda ids: np.zeros(len(ids), bool)).collect()
    assert all(r["train_tokens"] == 0 and r["bits_per_byte"] == pytest.approx(8.0) for r in none)
    empty = C.score(df.where("false"), F.lit(True), _is_training)
    assert empty.collect() == []


def test_contexts_share_no_counts():
    """The answers are the counts themselves, however many contexts there are,
    whether one chunk holds a context or several."""
    r = np.random.default_rng(3)
    chunks = [["".join(map(chr, r.integers(97, 123, 300))) for _ in range(20)] for _ in range(2)]
    total = Counter()
    for texts in chunks:
        data, offs = T.text_buffers(pa.array(texts))
        for c in C.contexts(data, offs)[0].tolist():
            for o in C.ORDERS:
                for bit in range(9):
                    total[o, (c & (1 << 8 * (o + 1)) - 1) >> 8 - bit, bit] += 1
    for k in known(chunks):
        full, apart = k.full(slice(None)), k.apart(slice(None))
        for i in r.integers(0, len(k.code), 200):
            for row, o in enumerate(C.ORDERS):
                c = int(k.code[i]) & (1 << 8 * (o + 1)) - 1
                for bit in range(8):
                    node, one = c >> 8 - bit, c >> 7 - bit & 1
                    zeros, ones = (total[o, node * 2 + x, bit + 1] for x in (0, 1))
                    assert full[bit, row, i] == C._stretched(np.array([zeros]), np.array([ones]))[0]
                    assert apart[bit, row, i] == C._stretched(np.array([zeros - (1 - one)]), np.array([ones - one]))[0]


def test_weights_are_learned_from_every_training_text(spark):
    """Long texts and texts beyond any fixed number count, by what they hold."""
    from basinflow.llm import exchange as X
    texts = ["long text " * 4000] + [f"text {i}" for i in range(900)]
    table = pa.table({"chunk": pa.array([0] * len(texts), pa.int32()), "doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    b = X.Batch(table)
    code, often = C.distinct_codes(b, np.ones(len(texts)))
    size = sum(len(t) + 1 for t in texts)
    assert often.sum() == size
    replies = C._code_counts([x for _, x in C._ask_codes(code, often, 1)])
    k = C.Known(C._packed(C._planes(code) + C._planes(often)), replies[0], [len(replies[0])], 1)
    total = k.learn(C.start(), 0)
    assert total[:C.GATES].sum() / C.FIXED == 8 * size
    learned, raw = C.single(C._averaged(C.start(), total)), C.single(C.start())
    assert (learned.log2_codes(code, k.full) * often).sum() > (raw.log2_codes(code, k.full) * often).sum()
