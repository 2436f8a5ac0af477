"""Token ids against the tokenizer library, and packing invariants."""
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from basinflow.llm import bpe_ids, packing
from basinflow.llm import textops as T
from basinflow.llm.queries import byte_bpe_path

DOCS = "doc_id long, text string, length string, rid int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizer_library(tokenizer):
    r = random.Random(5)
    parts = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "٣", ".", ",", "!",
             " ", "　", "中", "😀", "́", "x", "\r\n", "''", "\x1c", "\x00", "<|endoftext|>", "hello", "The"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(3000)] + ["", None, "a" * 5000]
    enc = bpe_ids.Encoder(byte_bpe_path())
    for _, _, data, offs in T.text_slices(pa.array(texts), 4000):
        ids, n = enc.encode(data, offs)
        ends = np.cumsum(n)
        for k in range(len(n)):
            text = data[offs[k]:offs[k + 1]].tobytes().decode()
            assert ids[ends[k] - n[k]:ends[k]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(1)
    length = rng.integers(1, 600, 800)
    cap = (1024, 5, 500_000.0)
    seq, off = packing.best_fit(length, cap, (1.0, 0.2, 0.3), rule)
    n = seq.max() + 1
    assert np.bincount(seq, length, n).max() <= cap[0]
    assert np.bincount(seq, minlength=n).max() <= cap[1]
    assert np.bincount(seq, length.astype(float) ** 2, n).max() <= cap[2]
    for s in range(n):
        at = np.flatnonzero(seq == s)
        at = at[np.argsort(off[at])]
        assert off[at].tolist() == (np.cumsum(length[at]) - length[at]).tolist()


def test_few_sequences_without_binding_capacities():
    rng = np.random.default_rng(2)
    for length in (rng.integers(1, 1024, 3000), np.minimum(1023, rng.lognormal(5.5, 1, 3000).astype(int) + 1)):
        seq, _ = packing.best_fit(length, (1024, 1024, 1024.0 ** 2))
        assert seq.max() + 1 <= math.ceil(length.sum() / 1024) * 1.01 + 1


def test_pieces_and_places_of_a_table(spark, tokenizer):
    r = random.Random(3)
    long = " ".join(f"word{i}" for i in range(3000))
    texts = [None, "", long, "tiny"] + ["".join(r.choice("abc \n'") for _ in range(r.randint(0, 3000))) for _ in range(60)]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "tiny", "clash", 1), (None, "no id", None, None)]
    df = spark.createDataFrame(rows, DOCS)
    out = packing.pack(packing.token_pieces(df, byte_bpe_path(), keep_ids=True), group_pieces=16).collect()
    want = {}
    for i, t in enumerate(texts):
        want[i] = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    docs, seqs = {}, {}
    for p in out:
        docs.setdefault(p["doc_id"], []).append(p)
        seqs.setdefault(p["sequence_id"], []).append(p)
    assert len(docs[3]) == 2 and len(docs[None]) == 1
    for i, ids in want.items():
        if i == 3:
            continue
        ps = sorted(docs[i], key=lambda p: p["piece"])
        assert [p["piece"] for p in ps] == list(range(len(ps)))
        assert sum((p["ids"] for p in ps), []) == ids
        assert [p["start"] for p in ps] == np.cumsum([0] + [p["length"] for p in ps])[:-1].tolist()
        assert all(p["length"] == 1024 for p in ps[1:]) and (len(ps) == 1 or len(ids) > 1024)
        assert all(p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in ps)
    for ps in seqs.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    total = sum(p["length"] for p in out)
    assert len(seqs) <= math.ceil(total / 1024) * 1.1 + 2


def test_bounds_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some words here to pack")], "doc_id long, text string")
    with pytest.raises(ValueError):
        packing.pack(packing.token_pieces(df, byte_bpe_path()), max_cost=4.0)
    none = spark.createDataFrame([], DOCS)
    assert packing.pack(packing.token_pieces(none, byte_bpe_path())).collect() == []
