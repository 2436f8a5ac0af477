"""N-gram Jaccard join against all pairs on small, skewed inputs."""
import random
import re

import numpy as np
import pyarrow as pa

from basinflow.llm import jaccard_join as J

DOCS = "doc_id long, text string, n_shingles string, component_id int"
SMALL = {"chunk_bytes": 2000, "bucket_bytes": 3000}


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute(rows, k=5, percent=80):
    sets = {}
    for d, t in rows:
        w = words(t)
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def corpus(seed):
    r = random.Random(seed)

    def prose(n):
        return " ".join("".join(r.choice("abcdefg") for _ in range(r.randint(1, 5))) for _ in range(n))
    texts = [None, "", " \t\n", "one two", "ONE two", "one two three four five", "one two three four five six"]
    shared = prose(40)
    for _ in range(3):
        base = prose(80).split()
        for _ in range(25):                       # edited copies of one original
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 4])):
                w[r.randrange(len(w))] = prose(1)
            texts.append(" ".join(w))
        chain = list(base)
        for _ in range(12):                       # each a copy of the one before
            chain[r.randrange(len(chain))] = prose(1)
            texts.append(" ".join(chain).upper())
    texts += [shared + " " + prose(r.randint(5, 60)) for _ in range(30)]
    texts += [prose(60)] * 8
    r.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def test_components_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE_ROWS", 5)        # cut hot tiles into lots
    monkeypatch.setattr(J, "GROUP_ROWS", 40)
    rows = corpus(2)
    df = spark.createDataFrame([(*x, "clash", 7) for x in rows], DOCS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.join(df, **SMALL).collect()}
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, long), (5, long), (9, long + " end"), (None, long), (2, "x" * 100_000), (3, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in J.join(df).collect())
    n = 30_000 - 4
    assert got == [(0, n, None), (2, 1, 2), (3, 1, 2), (5, n, 5), (5, n, 5), (9, n + 1, 5)]
    kept = sorted((r["doc_id"] or 0) for r in J.keep_first(df).collect())
    assert kept == [0, 2, 5, 5]


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert J.join(df).collect() == [] and J.keep_first(df).collect() == []


def test_bit_counts_never_rule_out_a_link():
    rng = np.random.default_rng(3)
    pairs = J._tile_pairs(80)
    for _ in range(20):
        base = rng.integers(0, 2**63, 300).astype(np.uint64)
        sets = [np.unique(np.concatenate([base[: 300 - k], rng.integers(0, 2**63, k).astype(np.uint64)])) for k in range(0, 60, 6)]
        t = pa.table({"key": pa.array([1] * 10), "band": [2] * 10, "lot_a": [0] * 10, "lot_b": [0] * 10, "lot": [0] * 10,
                      "guest": [0] * 10, "id": pa.array(range(10)), "n_shingles": [len(s) for s in sets],
                      "n_shared": [len(s) for s in sets], "component": pa.array(range(10)),
                      "signature": pa.array([J._signature(s) for s in sets], pa.list_(pa.int64()))})
        kept = set(zip(*[pairs(t).column(c).to_pylist() for c in "ab"], strict=True))
        for i in range(10):
            for j in range(i + 1, 10):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    assert (i, j) in kept


def test_links_are_all_pairs_between_different_texts(spark):
    """Edited copies of one text link with each other, not only with a pivot."""
    from basinflow.llm import jaccard_join as J
    base = [f"w{i}" for i in range(120)]
    texts = {i: " ".join(base[:i] + [f"new{i}"] + base[i + 1:]) for i in range(0, 120, 10)}
    texts |= {500: texts[10], 600: "other words that nobody else has at all", 700: " ".join(base[:60]), 800: " ".join(base)}

    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    sets = {d: shingles(t) for d, t in texts.items()}
    want = {(a, b) for a in texts for b in texts if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    pairs, members = J.links(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    pairs, of = [tuple(r) for r in pairs.collect()], {}
    for r in members.collect():
        of.setdefault(r["id"], []).append(r["doc_id"])
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    got = {tuple(sorted((x, y))) for a, b in pairs for x in of[a] for y in of[b]}
    got |= {(x, y) for docs in of.values() for x in docs for y in docs if x < y}
    assert got == want and len(want) > 50


def test_groups_stay_bounded_beside_a_huge_tile(spark, monkeypatch):
    """Rows are counted after the lots have multiplied them."""
    monkeypatch.setattr(J, "TILE_ROWS", 50)
    monkeypatch.setattr(J, "GROUP_ROWS", 500)
    monkeypatch.setattr(J, "_tile_pairs", lambda percent: lambda t: pa.table(
        {"a": pa.array([t.num_rows], pa.int64()), "b": t.column("id").slice(0, 1).combine_chunks().cast(pa.int64())}))
    keys = [(1, i) for i in range(1000)] + [(2 + i // 3, 1000 + i) for i in range(600)]
    side = spark.createDataFrame([(k, i, 10, 10, i, 10, [0]) for k, i in keys],
                                 "key long, id long, n_shingles int, n_shared int, component long, band int, signature array<long>")
    sizes = [r["a"] for r in J._candidate_pairs(side, 80).collect()]
    # 1,000 rows of the huge tile meet in 20 lots each; a band of guests alone is no tile.
    assert sum(sizes) > 0.9 * (1000 * 20 + 600) and max(sizes) < 5 * J.GROUP_ROWS and len(sizes) > 30
