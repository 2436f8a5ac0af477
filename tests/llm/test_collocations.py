"""Collocations against plain counting, with the contract's exact scores."""
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basinflow.llm import collocations as C

DOCS = "doc_id long, text string, lang string, phrase string, bucket int"


def brute(rows, min_count, top=2000):
    f, out = {}, []
    for _, text, lang, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            c = f.setdefault("und" if lang is None else lang, Counter())
            for k in (1, 2, 3):
                c.update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= min_count}
        got = []
        for g, a in cand.items():
            if any(100 * b >= 50 * a and g in (h[:2], h[1:]) for h, b in cand.items() if len(g) == 2 and len(h) == 3):
                continue
            score, _, left, right = min((1_000_000 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            got.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, r, g.decode(), -a, x, y, n, -s) for r, (s, a, g, x, y) in enumerate(sorted(got)[:top], 1)]
    return sorted(out)


def _rows(seed=1, many=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(12)] + ["é", "the", "THE", "日本", "x" * 1500]
    rows = [(1, None, "en", "p", 0), (2, "", None, "p", 0), (3, " \t. , \n", "en", "p", 0), (4, "a b c " * 4000, "hot", "p", 0),
            (5, "one,two;three", "en", "p", 0), (6, "a b c\x0cd e\x00 f\x00 " * 12, "en", "p", 0)]
    for k in range(many):
        words = [rng.choice(vocab) + rng.choice(["", "", "", ".", ", ", "\n", "!"]) for _ in range(rng.randint(1, 120))]
        rows.append((k, " ".join(words), rng.choice(["en", "de", None]), "p", 0))
    return rows + [rows[10]] * 3


@pytest.mark.parametrize("buffer_bytes,bucket_bytes", [(300, 500), (1 << 20, 1 << 20)])
def test_against_plain_counts(spark, buffer_bytes, bucket_bytes):
    rows = _rows()
    got = C.mine(spark.createDataFrame(rows, DOCS), min_count=4, buffer_bytes=buffer_bytes, bucket_bytes=bucket_bytes).collect()
    want = brute(rows, 4)
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got) == want
    assert {w[0] for w in want} >= {"hot", "en", "und"}


def test_limit_is_by_language_and_ties_by_bytes(spark):
    rows = [(k, "b a. a b. Z z. é é. " * 3, lang, "", 0) for k, lang in enumerate(["en", "de"])]
    got = C.mine(spark.createDataFrame(rows, DOCS), top=2, min_count=2).collect()
    assert sorted((r["lang"], r["rank"], r["phrase"]) for r in got) == [x[:3] for x in brute(rows, 2, 2)]


def test_scores_past_64_bits(spark):
    a, left, right = 3 * 10**12 + 1, 5 * 10**12 + 3, 4 * 10**12 + 7
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(
        C._score(*map(F.col, "alr")).alias("s")).first()
    assert row["s"] == 1_000_000 * a * a // (left * right)


def test_large_vocabulary_of_a_buffer():
    import numpy as np
    words = [f"v{k}" for k in range(2_200_000)]
    data = np.frombuffer((" ".join(words) + " v0 v1 v2").encode(), np.uint8)
    total = {1: 0, 2: 0}
    for _, kind, _, blob, size in C._stripes("en", [(data, np.array([0, len(data)]))], 4):
        *_, times = C._read_stripes(blob, size) if kind == 2 else C._read_words(blob, size)[:2]
        total[kind] += int(times.sum())
    assert total == {1: len(words) + 3, 2: len(words) + 3}


def test_empty_table(spark):
    assert C.mine(spark.createDataFrame([], DOCS)).collect() == []
    assert C.mine(spark.createDataFrame([(1, "a b", "en", "", 0)], DOCS)).collect() == []
