"""The pipeline's stages on their own input, against plain versions."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
pipeline = pytest.importorskip("corpus_pipeline")

from basinflow.llm import jaccard_join, mixing, quality_rules, secret_scan  # noqa: E402
from basinflow.llm.store import cut, read_table  # noqa: E402
from test_jaccard_join import brute as brute_components  # noqa: E402
from test_quality_rules import brute as brute_statistics  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    rules = quality_rules.fit_rules(docs, read_table(spark, SF, "labels"))
    before = docs.collect()
    after = cut(pipeline.keep_quality(spark, docs, SF), "t")
    kept = {r["doc_id"] for r in after.collect()}
    assert after.columns == columns
    for r in before:
        n = brute_statistics(r["text"])
        if n[0] < 50 or 100 * n[4] > 50 * n[0]:
            assert r["doc_id"] not in kept
        elif not rules:
            assert r["doc_id"] in kept

    before = after.collect()
    after = cut(pipeline.drop_near_copies(spark, after, SF), "t")
    comp = brute_components([(r["doc_id"], r["text"]) for r in before])
    assert after.columns == columns
    assert {r["doc_id"] for r in after.collect()} == {d for d, (_, c) in comp.items() if c == d}

    before = {r["doc_id"]: r for r in after.collect()}
    after = cut(pipeline.mask_secrets(spark, after, SF), "t")
    got = {r["doc_id"]: r for r in after.collect()}
    assert after.columns == columns and got.keys() == before.keys()
    for d, r in got.items():
        found = secret_scan.find(before[d]["text"] or "")
        if not found:
            assert r == before[d]
        assert r["n_chars"] == len(r["text"] or "")

    sampled = cut(pipeline.mix_sources(spark, after, SF), "t")
    assert sampled.columns == columns
    marks = mixing.mix(after, pipeline.MIX_TARGETS, pipeline.MIX_FRACTION, topics=pipeline.MIX_TOPICS, into="m").collect()
    assert {r["doc_id"] for r in sampled.collect()} == {r["doc_id"] for r in marks if r["m"]["sampled"]}

    packed = pipeline.pack_sequences(spark, sampled, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in sampled.select("doc_id").collect()}


def test_empty_documents(spark, tmp_path):
    docs = read_table(spark, SF, "documents").where("false")
    for _, stage in pipeline.STAGES:
        docs = cut(stage(spark, docs, SF), "t")
    assert docs.count() == 0


def test_names():
    assert [n for n, _ in pipeline.STAGES][1] == "n-gram Jaccard join" and len(pipeline.STAGES) == 5
    assert jaccard_join.SHINGLE == 5 and jaccard_join.PERCENT == 80
