"""Substring dedup against a direct reading of the contract."""
import hashlib
import random
import re

import pytest

from basinflow.llm import substring_dedup as S

DOCS = "doc_id long, text string, kept string, n_words int"
SMALL = {"chunk_bytes": 3000, "bucket_bytes": 2000}


def brute(rows, k=13):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    owner = {}
    for d, w in words:
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            owner[g] = min(owner.get(g, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if owner[tuple(w[i:i + k])] < d:
                gone[i:i + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)

    def prose(n, letters="abcdefghijklmnop"):
        return [r.choice(letters) + r.choice(letters) for _ in range(n)]
    passages = [prose(n) for n in (13, 14, 20, 60)]
    docs = [None, "", "one", " ".join(passages[0][:12]), "a " * 40, "a " * 13, "a\tb\n" * 30]
    for _ in range(60):
        w = []
        for _ in range(r.randint(1, 4)):
            w += prose(r.randint(0, 30))
            p = r.choice(passages)
            i = r.randint(0, len(p) // 2)
            w += p[i:r.randint(i, len(p))]
        docs.append(r.choice([" ", "\n", " \t"]).join(w))
    docs += [docs[-1]] * 5
    r.shuffle(docs)
    return [(i * 2 + 5, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed,sizes", [(1, {}), (2, SMALL)])
def test_matches_brute_force(spark, seed, sizes):
    rows = corpus(seed)
    df = spark.createDataFrame([(*x, "clash", 3) for x in rows], DOCS)
    got = S.remove_repeats(df, **sizes).collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")) for r in got) == brute(rows)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_long_text_repeated_rows_and_null_id(spark):
    text = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, text), (1, text), (2, "x" * 50_000 + " " + text), (None, "v " + text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in S.remove_repeats(df).collect())
    assert got == [(0, 20_001, 0), (1, 20_000, 20_000), (1, 20_000, 20_000), (2, 20_001, 20_000)]


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []
