"""I-Match fingerprints: edited texts, neighbours, and a plain version."""
import hashlib
import random

import pytest

from basinflow.llm import imatch as I

DOCS = "doc_id long, text string, terms string, key int"


def corpus():
    r = random.Random(2)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(1500)]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 120))) for _ in range(150)]
    texts += [None, "", "é", "中文 text", texts[3], texts[3], "X " + texts[5]]
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def result(spark):
    df = spark.createDataFrame([(*x, "clash", 1) for x in corpus()], DOCS)
    return I.compare_neighbours(df, rows_per_bucket=20, chunk_rows=7)


def test_edited_texts_and_neighbours(result):
    rows = sorted(corpus(), reverse=True)
    got = {r["doc_id"]: r for r in result.collect()}
    assert len(got) == len(rows)
    by_text = {}
    for k, (d, t) in enumerate(rows):
        t, nxt, r = t or "", rows[(k + 1) % len(rows)], got[d]
        half = len(t) // 2
        edited = t[:len(t) - half] + (nxt[1] or "")[:half]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert r["near_next"] == pytest.approx(alike(r["fingerprint"], got[nxt[0]]["fingerprint"]))
        assert r["near_edited"] == pytest.approx(alike(r["fingerprint"], r["edited_fingerprint"]))
        if edited == t:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1.0
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > len(got) / 2


def alike(a, b):
    a, b = a.split("."), b.split(".")
    n = max(len(a), len(b))
    a, b = a + [""] * (n - len(a)), b + [""] * (n - len(b))
    filled = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
    return sum(x == y for x, y in filled) / len(filled) if filled else 0.0


def test_no_python_on_the_main_path(result):
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_texts_are_shuffled_once(spark):
    """Asking and answering read one exchange of the texts."""
    rows = [(i, f"w{i} w{i // 2} w{i // 3}") for i in range(50)]
    got = I.compare_neighbours(spark.createDataFrame(rows, "doc_id long, text string"), rows_per_bucket=20)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.find("== Initial Plan")]
    by_number = [x for x in final.splitlines() if "REPARTITION_BY_NUM" in x and "Reused" not in x]     # the texts, and the answers
    assert "ReusedExchange" in final and len(by_number) == 2 and final.count("lead(text") >= 2


def test_band_against_plain_document_frequencies(spark):
    """A term's part is filled exactly where its document frequency is in the
    band: counted over own texts, not over edited ones."""
    texts = ["often " * (k % 2) + f"pair{k // 2} one{k} " + ("mid" if k % 5 == 0 else "") for k in range(60)]
    df = {}
    for t in texts:
        for w in set(t.split()):
            df[w] = df.get(w, 0) + 1
    n, band = len(texts), (0.2, 0.95)
    low, high = max(n ** (1 - band[1]), 2), n ** (1 - band[0])
    lined, many, buckets = I.in_chunks(spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "key long, text string, kind int"), 16, 5)
    rows = lined.select("bucket", "chunk", "extra", I.terms(I.F.col("text")).alias("own"),
                        I.terms(I.F.when(I.F.col("extra"), "").otherwise(I.edited(I.F.col("text"), I.F.col("next_text")))).alias("edited"))
    known = I.known_terms(rows, many, buckets, band).select(I.F.explode(I.F.flatten(I.F.filter(I.F.flatten("known"), lambda x: x.isNotNull()))).alias("h")).distinct()
    words = spark.createDataFrame([(w,) for w in df], "w string").select("w", I.F.xxhash64("w").alias("h"))
    got = {r["w"] for r in words.join(known, "h").collect()}
    assert got == {w for w, c in df.items() if low <= c <= high} and many == n


def test_subsets_agree_with_a_plain_reading(spark):
    """Parts are equal exactly where the subset's terms are equal."""
    rows = spark.createDataFrame([(1, [5, 9, 44]), (2, [5, 9, 45]), (3, [])], "id long, t array<long>")
    got = {r["id"]: r["p"] for r in rows.select("id", I.parts(I.F.col("t")).alias("p")).collect()}
    members = {}
    for h in (5, 9, 44, 45):
        one = spark.createDataFrame([(0, [h])], "id long, t array<long>")
        members[h] = [bool(x) for x in one.select(I.parts(I.F.col("t")).alias("p")).first()["p"]]
    for k in range(len(got[1])):
        a = [h for h in (5, 9, 44) if members[h][k]]
        b = [h for h in (5, 9, 45) if members[h][k]]
        assert (got[1][k] == got[2][k]) == (a == b) and (got[1][k] == "") == (not a)
    assert set(got[3]) == {""}


def test_single_row_nulls_and_empty_table(spark):
    one = I.compare_neighbours(spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0
    rows = [(None, "no id"), (3, "same"), (3, "same"), (8, "word " * 60_000)]
    assert I.compare_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).count() == 4
    assert I.compare_neighbours(spark.createDataFrame([], DOCS)).collect() == []


def test_every_term_may_be_in_the_lexicon(spark):
    """By default no term is dropped before document frequencies are counted:
    each word of the band, alone in a text, makes a lexicon fingerprint."""
    rows = [(i, f"word{i // 4}") for i in range(160)]
    got = I.compare_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 160 and not any(r["fingerprint"].startswith("text:") for r in got)
