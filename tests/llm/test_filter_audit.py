"""Filter audit against a plain walk through every order."""
import random
from collections import Counter

import pytest

from basinflow.llm import filter_audit as A

DOCS = "doc_id long, text string, source string, mask int, part string"
LABELS = "doc_id long, quality int, toxic int, text string"


def fails(rows, doc_id, text):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    same = [i for i, t, *_ in rows if (t or "") == text and i is not None]
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in text for c in "#$%&*|"),
            "E": doc_id is not None and any(i < doc_id for i in same)}


def brute(rows, labels):
    out = Counter()
    docs = [(s or "", fails(rows, i, t or ""), any(q == 1 for d, q, *_ in labels if d == i and i is not None),
             any(x == 1 for d, _, x, _ in labels if d == i and i is not None)) for i, t, s, *_ in rows]
    shap = Counter()
    for order in A.ORDERS:
        left = docs
        for step, f in enumerate(order, 1):
            for p in {p for p, *_ in docs}:
                key = (p, order, step)
                out[key, "kept"] = sum(p == d[0] and not d[1][f] for d in left)
                gone = [d for d in left if p == d[0] and d[1][f]]
                out[key, "removed"] = len(gone)
                shap[p, f] += len(gone)
                out[key, "good_lost"], out[key, "toxic_lost"] = sum(d[2] for d in gone), sum(d[3] for d in gone)
                failing = [d for d in docs if p == d[0] and d[1][f]]
                out[key, "redundant"] = len(failing) - len(gone)
                out[key, "unique_fails"] = sum(sum(d[1].values()) == 1 for d in failing)
            left = [d for d in left if not d[1][f]]
    for p in {p for p, *_ in docs}:
        for order in A.ORDERS:
            for step, f in enumerate(order, 1):
                out[(p, order, step), "shapley"] = shap[p, f]
    return out


def _rows():
    rng = random.Random(5)
    long = " ".join(f"w{k}" for k in range(220))
    rows = [(None, "x", "a", 1, "z"), (None, "x", None, 1, "z"), (1, None, "a", 1, "z"), (2, "", None, 1, "z"), (3, long, "a", 1, "z"),
            (4, long, "b", 1, "z"), (4, long, "b", 1, "z"), (4, "other", "b", 1, "z"), (5, long + " #", "b", 1, "z"),
            (6, "same " * 300, "a", 1, "z"), (7, "ABC " * 300, "a", 1, "z"), (8, "é" * 50_000, "b", 1, "z"), (9, long.upper(), "", 1, "z")]
    pool = [long + f" {k}" * rng.randint(0, 3) for k in range(6)] + ["short", "Ab#", ""]
    return rows + [(10 + k, rng.choice(pool), rng.choice(["a", "b", None]), 1, "z") for k in range(60)]


def test_audit_against_plain_walk(spark):
    rows = _rows()
    labels = [(k, k % 2, int(k % 3 == 0), "t") for k in range(0, 60, 2)] + [(3, 0, 1, "t"), (3, 1, 0, "t"), (None, 1, 1, "t"), (999, 1, 1, "t")]
    got = A.audit(A.masks(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), local_bytes=2000, range_bytes=3000,
                          least_heavy=500)).collect()
    want = brute(rows, labels)
    assert len(got) == 600 * 3
    for r in got:
        key = (r["part"], r["filter_order"], r["step"])
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"):
            assert r[c] == want[key, c], (key, c)


def test_trie_holds_least_and_whole_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(3000)]
    trie = A.Trie()
    for i, t in enumerate(reversed(texts)):
        trie.insert(t, (len(texts) - 1 - i, t))
    least = {}
    for i, t in enumerate(texts):
        least.setdefault(t, i)
    assert sorted(trie.terminals()) == sorted((i, t) for t, i in least.items())
    for k in range(2000):                                  # a chain of nested texts: deep, not recursive
        trie.insert(b"c" * k, (k, b"c" * k))
    assert len(list(trie.terminals())) == len(least) + 1999 + (b"" not in least)


@pytest.mark.parametrize("local_bytes", [1, 1 << 20])
def test_long_common_prefixes_and_many_copies(spark, local_bytes):
    shared = "s" * 3000
    rows = [(k, shared + str(k % 40), "h", 0, "") for k in range(400)] + [(1000 + k, "hot copy", "h", 0, "") for k in range(500)]
    first = A.first_holders(spark.createDataFrame(rows, DOCS), local_bytes=local_bytes, range_bytes=20_000, least_heavy=4000).collect()
    assert sorted(r["id"] for r in first) == [*range(40), 1000]
    heavy = A._heavy(spark.createDataFrame([(shared + str(k), k) for k in range(40)], "t string, h long")
                     .selectExpr("h", "cast(t as binary) text"), 50_000)
    assert [n for n, _ in heavy] == [16, 64, 256, 1024]


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit(A.masks(spark.createDataFrame([], DOCS), none)).collect() == []
    got = A.audit(A.masks(spark.createDataFrame([(1, "x", "a", 0, "")], DOCS), none))
    assert got.count() == 600 and got.where("good_lost + toxic_lost > 0").count() == 0
