"""Text statistics against plain Python, learned lists, and the verdicts."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from basinflow.llm import quality_rules as Q
from basinflow.llm import textops as T
from basinflow.llm.queries import QUERIES


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i:i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover))


def test_statistics_match_plain_python():
    r = random.Random(4)
    texts = [None, "", "\n", "a", " a\n a\na", "x y z x y z", "é*é\né*é\n\n\n", "a\r\nb\r\na\r\n", "w " * 500]
    texts += ["".join(r.choice(["a", "b", " ", "\n", "é", "#", "\t", "\v", "中"]) for _ in range(r.randint(0, 80))) for _ in range(800)]
    for _, _, data, offs in T.text_slices(pa.array(texts), 700):
        st = Q.statistics(data, offs)
        got = list(zip(*[st[c].tolist() for c in Q.COUNTS], strict=True))
        assert got == [brute(data[offs[i]:offs[i + 1]].tobytes().decode()) for i in range(len(offs) - 1)]


def test_list_learns_a_planted_rule():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(Q.FEATURES)))
    bad = (x[:, 2] > 0.8) & (x[:, 5] <= 0.5)
    rules = Q.learn_rules(x, bad)
    hit = np.zeros(len(x), bool)
    for rule in rules:
        hit |= Q._covers(rule, x)
    assert (hit == bad).mean() > 0.97
    assert Q.learn_rules(x, np.zeros(len(x), bool)) == [] and Q.learn_rules(x[:0], bad[:0]) == []


def test_query_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op7_quality_rules"][0](spark, sf).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    for d, t in zip(docs["doc_id"], docs["text"], strict=True):
        r, want = out.loc[d], brute(t)
        assert tuple(r[c] for c in Q.COUNTS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    both = out.join(labels.set_index("doc_id"), how="inner")
    sound = both[~both["base_failed"]]
    assert (sound["kept"] == (sound["quality"] == 1)).mean() > 0.95


def test_edges_and_pass_through(spark):
    rows = [(1, None, "a", True), (2, "good words " * 5, "b", None), (2, "good words " * 5, "b", None), (None, "x" * 100_000, "c", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, stats string, kept boolean")
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (77, 0)], "doc_id long, quality int")
    rules = Q.fit_rules(df, labels)
    out = Q.judge(df, rules, into="v")
    assert out.columns == [*df.columns, "v"] and out.count() == 4
    assert Q.keep_good(df, rules).columns == df.columns
    none = df.where("false")
    assert Q.judge(none, Q.fit_rules(none, labels.where("false")), into="v").collect() == []
