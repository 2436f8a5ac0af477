"""The two classifiers' queries against plain Python over whole tables."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basinflow.llm import quality_fm, quality_rules, toxicity
from basinflow.llm import textops as T
from basinflow.llm.queries import QUERIES
from basinflow.llm.store import read_table

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def mix(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & MASK
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ h >> 33


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()


def grams(text):
    """Hashed character n-grams of a text, one by one."""
    low, out = lowered(text), set()
    for order in toxicity.ORDERS:
        for i in range(len(low) - order + 1):
            out.add(mix(int.from_bytes(low[i:i + order], "little") + order) >> 64 - toxicity.BITS)
    return out


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


@pytest.fixture(scope="module")
def tables(spark):
    return read_table(spark, SF, "documents"), read_table(spark, SF, "labels")


def training(docs, labels, label):
    """Labelled texts outside the held-out fold, by id."""
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    return {r["doc_id"]: (text[r["doc_id"]], r[label]) for r in labels.collect()
            if r["doc_id"] in text and r[label] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0}


def test_toxicity_counts_ratios_and_scores(spark, tables):
    docs, labels = tables
    rows = training(docs, labels, "toxic")
    counts, totals = [Counter(), Counter()], [0, 0]
    for text, y in rows.values():
        counts[y].update(grams(text))
        totals[y] += 1
    sample = quality_rules.labelled_sample(docs, labels, "toxic")
    got = toxicity.class_counts(sample)
    for y in (0, 1):
        assert {int(f): int(got[y, f]) for f in np.flatnonzero(got[y])} == dict(counts[y])
    model = toxicity.fit(docs, labels)
    taking_part = {f for f in {*counts[0], *counts[1]} if counts[0][f] + counts[1][f] >= 5
                   and abs(math.log((counts[1][f] + 1) / (totals[1] + 2)) - math.log((counts[0][f] + 1) / (totals[0] + 2))) >= 1.0}
    assert set(np.flatnonzero(model.weight).tolist()) <= taking_part
    out = {r["doc_id"]: r for r in QUERIES["op4_toxicity"][0](spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert out.keys() == texts.keys()
    for d, t in texts.items():
        z = model.bias + sum(model.weight[f] for f in grams(t))
        assert out[d]["score"] == pytest.approx(sigmoid(z), abs=1e-9)
        assert out[d]["predicted"] == int(out[d]["score"] >= 0.5)


def test_fit_is_near_the_optimum_of_the_stated_loss(tables):
    """A step of plain gradient descent from the fitted coefficients does not
    lower the penalised logistic loss by much."""
    rng = np.random.default_rng(1)
    n, m = 300, 40
    x = rng.random((n, m)) < 0.2
    y = (x[:, :5].sum(1) + rng.random(n) > 1.2).astype(float)
    ratio = rng.normal(size=m)
    rows, feats = np.nonzero(x)
    w, b = toxicity.logistic(rows, feats, ratio, y, l2=0.5, steps=3000)

    def loss(w, b):
        z = (x * ratio) @ w + b
        return np.mean(np.logaddexp(0, z) - y * z) + 0.5 * 0.5 * (w @ w) / n

    best = loss(w, b)
    for _ in range(20):
        assert loss(w + rng.normal(size=m) * 0.02, b + rng.normal() * 0.02) > best - 1e-5


def test_quality_inputs_and_scores(spark, tables):
    docs, labels = tables
    model = quality_fm.fit(docs, labels)
    out = {r["doc_id"]: r for r in QUERIES["op9_quality_fm"][0](spark, SF).collect()}
    rows = docs.collect()
    assert out.keys() == {r["doc_id"] for r in rows}
    for r in rows:
        low = lowered(r["text"])
        words = [w for w in re.split(rb"[\x20\x09-\x0d]+", low) if w]
        held = Counter()
        for w, n in Counter(words).items():
            raw = np.frombuffer(w, np.uint8)
            held[int(T.hash_spans(raw, np.array([0]), np.array([len(w)]))[0]) >> 64 - quality_fm.WORD_BITS] += n
        data, offs = T.text_buffers(pa.array([r["text"]], pa.string()))
        dense = model.standard(quality_fm.dense_inputs(data, offs))[0]
        assert quality_fm.dense_inputs(data, offs)[0][-2:] == pytest.approx([math.log1p(len(low)), math.log1p(len(words))])
        at = np.array([*held, *(quality_fm.WORDS + np.arange(len(dense)))], np.int64)
        x = np.array([*(math.sqrt(n / len(words)) for n in held.values()), *dense])
        pairs = model.v[at] @ model.v[at].T * np.outer(x, x)          # every pair, not the identity
        z = model.bias + model.w[at] @ x + np.triu(pairs, 1).sum()
        assert out[r["doc_id"]]["score"] == pytest.approx(sigmoid(z), abs=1e-6)
        assert out[r["doc_id"]]["predicted"] == int(out[r["doc_id"]]["score"] >= 0.3)
