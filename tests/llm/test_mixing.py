"""Raking against its definition, and sampling by calibrated probabilities."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basinflow.llm import mixing as M
from basinflow.llm import mixing_topics as MT
from basinflow.llm import textops as T

DOCS = "doc_id long, text string, source string, lang string, mix string, tokens int"


def test_raking_meets_feasible_targets_and_never_exceeds_a_cell():
    rng = np.random.default_rng(0)
    tokens = rng.integers(1000, 5000, (3, 4, 2)).astype(float)
    shares = [np.array([0.2, 0.3, 0.5]), np.array([0.25] * 4), np.array([0.6, 0.4])]
    budget = 0.3 * tokens.sum()
    x = M.rake(tokens, shares, budget)
    for d, share in enumerate(shares):
        assert np.allclose(x.sum(tuple(k for k in range(3) if k != d)) / budget, share, atol=1e-4)
    tokens[0] = 10.0
    assert (M.rake(tokens, shares, 0.9 * tokens.sum()) <= tokens + 1e-9).all()


def table(spark):
    rows = []
    for i in range(600):
        source, lang = ("a", "b", "c", "d")[i % 4 if i % 3 else 0], ("en", "de")[i % 5 == 0]
        rows.append((i, f"word{i % 7} " * (i % 40) + f" theme{i % 2}x{i % 11} theme{i % 2}x{i % 5}", source, lang, "clash", 1))
    rows += [(601, None, None, None, None, None), (602, "", "a", "zz", None, None), (7, "word0 " * 7, "d", "en", "clash", 1),
             (None, "text without an id", "a", "en", None, None)]
    return spark.createDataFrame(rows, DOCS)


TARGETS = {"source": {"a": 0.3, "b": 0.3, "c": 0.3}, "lang": {"en": 0.5, "de": 0.4}, "topic": {"0": 0.5, "1": 0.5}}


def test_brute_force_and_pass_through(spark):
    df = table(spark)
    got = M.mix(df, TARGETS, 0.25, topics=2, into="m")
    assert set(df.columns) < set(got.columns)
    rows = got.collect()
    assert len(rows) == df.count()
    # The same cells from plain Python, raked by plain loops.
    names, cells = list(TARGETS), {}
    for r in rows:
        cell = tuple(r["m"][n] for n in names)
        cells[cell] = cells.get(cell, 0) + r["m"]["tokens"]
        assert r["m"]["tokens"] == len((r["text"] or "").split())
    x = {c: 0.25 * t for c, t in cells.items()}
    budget = 0.25 * sum(cells.values())
    for _ in range(500):
        for d, n in enumerate(names):
            cats = {c[d] for c in cells}
            has = {k: sum(t for c, t in cells.items() if c[d] == k) for k in cats}
            share = {k: TARGETS[n].get(k) for k in cats}
            rest = max(0.0, 1 - sum(TARGETS[n].values()))
            share = {k: (rest if rest > 1e-12 else has[k] / sum(cells.values())) if v is None else v for k, v in share.items()}
            share = {k: v if has[k] else 0.0 for k, v in share.items()}
            total = sum(share.values())
            for k in cats:
                s = sum(v for c, v in x.items() if c[d] == k)
                for c in x:
                    if c[d] == k:
                        x[c] = min(cells[c], x[c] * (budget * share[k] / total / s if s else 0))
    for r in rows:
        cell = tuple(r["m"][n] for n in names)
        want = x[cell] / cells[cell] if cells[cell] else 1.0
        assert r["m"]["probability"] == pytest.approx(want, abs=1e-3)
    twice = [r["m"]["sampled"] for r in rows if r["doc_id"] == 7]
    assert len(twice) == 2
    kept = M.sample(df, TARGETS, 0.25, topics=2)
    assert kept.columns == df.columns and 0 < kept.count() < len(rows)


def test_uniform_and_bounds(spark):
    u = spark.range(20_000).select(M.uniform(F.col("id"), 3).alias("u")).toPandas()["u"]
    assert abs(u.mean() - 0.5) < 0.01 and u.min() >= 0 and u.max() < 1
    many = {"source": {str(i): 1e-4 for i in range(2000)}, "lang": {str(i): 1e-4 for i in range(2000)}}
    with pytest.raises(ValueError):
        M.mix(table(spark), many, 0.5)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert M.mix(none, TARGETS, 0.5, topics=2, into="m").collect() == []


THEMES = [[f"theme{t}word{k}" for k in range(40)] for t in range(3)]


def themed(spark):
    rng = np.random.default_rng(3)
    common = [f"common{k}" for k in range(30)]
    rows = [(i, " ".join([*rng.choice(THEMES[i % 3], 12), *rng.choice(common, 12)])) for i in range(300)]
    rows += [(i, text.upper()) for i, text in rows[:9]] + [(None, None), (400, ""), (401, "a few words"), (402, "x" * 9 + " " * 4000)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_topics_group_texts_by_theme(spark):
    rows, df = themed(spark)
    model = MT.fit_topics(df, 3)
    got = df.select("*", M.tokens_and_topic(F.col("text"), model).alias("m")).collect()
    assert len(got) == len(rows)
    found = [{r["m"]["topic"] for r in got if r["doc_id"] is not None and r["doc_id"] < 300 and r["doc_id"] % 3 == t} for t in range(3)]
    assert all(len(x) == 1 for x in found) and set().union(*found) == {0, 1, 2}
    assert all(r["m"]["topic"] is None for r in got if r["doc_id"] is None or r["doc_id"] >= 400)


def test_topics_equal_plain_python_and_any_partitioning(spark):
    rows, df = themed(spark)
    model = MT.fit_topics(df, 3)
    again = MT.fit_topics(df.repartition(7, "text"), 3)
    assert (model.weight == again.weight).all() and (model.centre == again.centre).all()

    def group(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        return int(T.hash_spans(raw, np.array([0]), np.array([len(raw)]))[0] % np.uint64(MT.FEATURES))

    sets = [s for s in ({group(w.lower()) for w in (t or "").split() if len(w.encode()) >= 6} for _, t in rows) if s]
    df_of = {f: sum(f in s for s in sets) for f in set().union(*sets)}
    weight = {f: round(64 * math.log2(len(sets) / n)) if n >= 2 else 0 for f, n in df_of.items()}
    assert {f: int(model.weight[f]) for f in weight} == weight and model.weight.astype(bool).sum() == sum(map(bool, weight.values()))
    order = sorted(weight, key=lambda f: (-df_of[f] * weight[f] ** 2, f))
    anchors = [f for f in order[:MT.CANDIDATES] if weight[f]]
    company = [{f: sum(a in s and f in s for s in sets) * weight[f] for f in weight} for a in anchors]

    def centre(profile):
        norm = math.sqrt(sum(v * v for v in profile.values()))
        return {f: round(v * 65536.0 / norm) for f, v in profile.items()}

    units = [centre(c) for c in company]
    like = lambda a, b: round(sum(units[a][f] * units[b][f] for f in weight) / 65536 ** 2, 9)
    chosen = [0]
    while len(chosen) < 3:
        chosen.append(min((k for k in range(len(anchors)) if k not in chosen), key=lambda k: (max(like(k, c) for c in chosen), k)))
    centres = [units[k] for k in chosen]

    def of(s):
        scores = [sum(c[f] * weight[f] for f in s) for c in centres]
        return scores.index(max(scores)) if max(scores) > 0 else None

    for _ in range(MT.ROUNDS):
        sums = [dict.fromkeys(weight, 0) for _ in centres]
        for s in sets:
            t, norm = of(s), math.sqrt(sum(weight[f] ** 2 for f in s))
            if t is not None:
                for f in s:
                    sums[t][f] += round(weight[f] * 65536 / norm)
        centres = [centre(x) if any(x.values()) else c for x, c in zip(sums, centres)]
    for t, c in enumerate(centres):
        assert max(abs(c[f] - int(model.centre[t, f])) for f in weight) <= 1
    got = [r["m"]["topic"] for r in df.select(M.tokens_and_topic(F.col("text"), model).alias("m")).collect()]
    full = [{group(w.lower()) for w in (t or "").split() if len(w.encode()) >= 6} for _, t in rows]
    assert got == [of(s) if s else None for s in full]


def test_no_topics_without_words(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "doc_id long, text string")
    for d in (df, df.limit(0)):
        model = MT.fit_topics(d, 4)
        assert model.centre.shape[0] == 0
        assert all(r["m"]["topic"] is None for r in d.select(M.tokens_and_topic(F.col("text"), model).alias("m")).collect())
