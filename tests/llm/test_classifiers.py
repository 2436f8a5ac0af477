"""Toxicity and quality classifiers: held-out accuracy and edge cases."""
import zlib

import numpy as np
import pyarrow as pa
import pytest

from basinflow.llm import quality_fm, toxicity
from basinflow.llm import textops as T
from basinflow.llm.queries import QUERIES
from basinflow.llm.store import read_table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,threshold", [("op4_toxicity", "toxic", 0.5), ("op9_quality_fm", "quality", 0.3)])
def test_held_out_accuracy(spark, name, label, threshold):
    got = QUERIES[name][0](spark, SF).toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= threshold)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    both = got.merge(read_table(spark, SF, "labels").toPandas(), on="doc_id")
    held = both[both["held_out"]]
    assert (held["predicted"] == held[label]).mean() >= 0.93


def small(spark, n=120):
    rows = [(i, ("you idiot moron " if i % 4 == 0 else "calm words here ") * 3 + f"tail {i}", "clash", 0.5) for i in range(n)]
    rows += [(n, None, None, None), (n + 1, "", None, None), (n + 2, "é" * 200_000, None, None), (None, "no id", None, None),
             (5, rows[5][1], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y string, score_ double")
    labels = [(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(n)]
    labels += [(1, None, None), (None, 1, 1), (9999, 1, 1), (2, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_fm, "quality")])
def test_edges(spark, module, label):
    docs, labels = small(spark)
    model = module.fit(docs, labels)
    got = toxicity.with_score(docs, model, into="s").toPandas()
    assert len(got) == docs.count() and got["s"].between(0, 1).all()
    plain = got[got["doc_id"] < 120]
    toxic = plain["doc_id"] % 4 == 0
    high, low = (plain["s"][toxic], plain["s"][~toxic]) if label == "toxic" else (plain["s"][~toxic], plain["s"][toxic])
    assert high.min() > low.max()
    for one in (labels.where("false"), labels.where(f"{label} = 1")):
        s = toxicity.with_score(docs, module.fit(docs, one), into="s").toPandas()["s"]
        assert s.nunique() == 1 and s.between(0, 1).all()
    assert toxicity.with_score(docs.where("false"), model, into="s").collect() == []


def test_log_count_ratio_against_counts():
    texts, y = ["abcd", "abcx", "zzzz", "zzza"], np.array([1, 1, 0, 0])
    counts = np.zeros((2, 1 << toxicity.BITS), np.int64)
    for t, c in zip(texts, y, strict=True):
        data, offs = T.text_buffers(pa.array([t]))
        counts[c, toxicity.present(data, offs) & ((1 << toxicity.BITS) - 1)] += 1
    ratio = toxicity.log_count_ratio(counts, np.array([2, 2]))
    data, offs = T.text_buffers(pa.array(["abc"]))
    f = toxicity.present(data, offs) & ((1 << toxicity.BITS) - 1)
    assert np.allclose(ratio[f], np.log((2 + 1) / 4 / ((0 + 1) / 4)))


def test_factor_machine_equals_all_pairs():
    rng = np.random.default_rng(0)
    k = len(quality_fm.DENSE)
    fm = quality_fm.FactorMachine(0.3, rng.normal(size=quality_fm.WORDS + k), rng.normal(size=(quality_fm.WORDS + k, 3)),
                                  np.zeros(k), np.ones(k))
    word, x, dense = np.array([3, 9, 70]), np.array([0.5, 0.2, 0.1]), rng.normal(size=(1, k))
    idx = np.concatenate([word, quality_fm.WORDS + np.arange(k)])
    v = np.concatenate([x, dense[0]])
    want = 0.3 + fm.w[idx] @ v + sum(fm.v[idx[i]] @ fm.v[idx[j]] * v[i] * v[j]
                                     for i in range(len(v)) for j in range(i + 1, len(v)))
    assert fm.logits(np.zeros(3, int), word, x, dense)[0] == pytest.approx(want)
