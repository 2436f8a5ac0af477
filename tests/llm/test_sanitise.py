"""Personal data and disclosing terms against plain Python."""
import math
import re

import pytest
from pyspark.sql import functions as F

from basinflow.llm import sanitise as S

DOCS = "doc_id long, text string, spans string, rid int"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    s = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def passes(kind, m):
    n = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")),
            "card": 12 <= len(n) <= 19 and luhn(n), "phone": 9 <= len(n) <= 15}[kind]


def base(text):
    return sorted((m.start(), list(PATTERNS).index(k), k, m.end())
                  for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0]))


TEXTS = [
    None, "", "nothing here", "a@b.cc_d@e.f x@y z@w.v.", "é🙂 me@host.example.com\nme@host.example.com", "1.2.3.4.5.6.7.8 999.1.1.1 00255.0.0.01 256.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "card 79927398713 000000000000", "+1 (555) 010-9999. +12345 +1-2-3-4-5-6-7-8-9-",
    "4" * 30_000, "a." * 20_000 + "@b.c", "x@" + "a.b" * 20_000, "1.1.1.1" * 3000, "5 5-5" * 5000, "mail:bob@x.org,al@y.org;+49 170 1234567", "a@b@c.d",
    "٣٣٣٣٣٣٣٣٣٣٣٣٣ + 0" * 4, "q" * 300_000 + " tail@end.net",
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], None, None), (None, TEXTS[4], None, None)]
    return S.spans(spark.createDataFrame(rows, DOCS)).collect()


def test_base_spans_of_every_kind_and_edge(found):
    assert len(found) == len(TEXTS) + 2
    for r in found:
        text = TEXTS[4] if r["doc_id"] is None else TEXTS[r["doc_id"]]
        got = [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["spans"] if s["rank"] < 4]
        assert got == base(text), r["doc_id"]


def _corpus():
    name = "Zerlina"
    rows = [(k, f"{name} wrote from z.k@corp.example to us about {w}", None, None) for k, w in enumerate(["tea", "rice", "milk"])]
    rows += [(10 + k, f"we wrote from the port about {k}", None, None) for k in range(30)]
    rows += [(50, "Copied quirk one@only.example", None, None)] * 3          # one text only: proves nothing
    rows += [(60 + k, f"partly {'red' if k else 'blue'} q@half.example", None, None) for k in range(2)] + [(70 + k, f"partly {k}", None, None) for k in range(4)]
    return rows


def test_terms_by_mutual_information(spark):
    docs = spark.createDataFrame(_corpus(), DOCS)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["share"]) for s in r["spans"] if s["rank"] > 3] for r in S.spans(docs).collect()}
    n = len(_corpus())
    assert got[0][0][:3] == ("remove", 0, 7) and math.isclose(got[0][0][3], 1.0)
    assert not any(s[1] == 8 for s in got[0])                               # "wrote" is everywhere
    assert got[50] == []
    share = math.log2(n * 2 / (2 * 6)) / math.log2(n / 2)                   # "partly" is in 6 documents, 2 of them beside q@
    want = "remove" if share >= S.REMOVE else "general" if share >= S.GENERALISE else None
    assert [x[0] for x in got[60]] == ([want] if want else [])
    assert all(got[k] == [] for k in range(10, 40))


def test_shares_against_plain_counts(spark):
    rows = _corpus()
    docs = spark.createDataFrame(rows, DOCS)
    hits = S.placed(S.matches(docs))
    pairs = S.disclosures(docs, hits, S.beside(hits), len(rows), generalise=-9.0).collect()
    texts = {i: [t for d, t, _, _ in rows if d == i] for i, *_ in rows}
    every = [t for ts in {k: v for k, v in texts.items()}.values() for t in ts]
    terms = {t: sum(t in {w.lower() for w in re.findall(r"[^\W\d_]+", x)} for x in every) for t in
             {w.lower() for x in every for w in re.findall(r"[^\W\d_]{3,}", x)}}
    seen = {(r["term"], round(r["share"], 9)) for r in pairs}
    n = len(rows)
    for term, both, entity in (("zerlina", 3, 3), ("wrote", 3, 3), ("from", 3, 3), ("partly", 2, 2)):
        assert (term, round(math.log2(n * both / (entity * terms[term])) / math.log2(n / entity), 9)) in seen


def test_far_and_cut_words_do_not_count(spark):
    far = "y" * 70
    rows = [(k, f"Hidden {far} a.b@c.de {far}x Other {k}", None, None) for k in range(3)] + [(9, "plain text", None, None)]
    got = S.spans(spark.createDataFrame(rows, DOCS)).collect()
    assert all(s["rank"] < 4 for r in got for s in r["spans"])


def test_sanitised_text(spark):
    rows = [*_corpus(), (None, None, None, None), (99, "+1 (555) 010-9999", "keep", 3)]
    out = {r["doc_id"]: r for r in S.sanitised(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[0]["text"].startswith(" wrote from [EMAIL] to us about")
    assert out[99]["text"] == "[PHONE]" and out[99]["spans"] == "keep" and out[None]["text"] is None
    assert out[10]["text"] == "we wrote from the port about 0"


def test_empty_table_and_no_python_in_the_plan(spark):
    empty = spark.createDataFrame([], DOCS)
    assert S.spans(empty).collect() == []
    docs = spark.createDataFrame([(1, "a@b.cd", None, None)], DOCS)
    hits = S.placed(S.matches(docs))
    for df in (S.spans(docs), S.sanitised(docs), S.disclosures(docs, hits, S.beside(hits), 1), S.document_counts(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert docs.select(S.span_text(F.lit([]).cast("array<struct<kind:string,start:int,end:int>>"))).first()[0] == ""
