"""Secret scans against a direct reading of the contract's patterns."""
import hashlib
import re

import pytest

from pyspark.sql import functions as F

from basinflow.llm import secret_scan as S

DOCS = "doc_id long, text string, source string, spans string, f1 int"


def brute(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text, re.IGNORECASE | re.ASCII):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


HEX = "0123456789abcdef01234567"
TEXTS = [
    None, "", "no secret here", f"é password = 'Ab12Cd34Ef56Gh78Ij' and {HEX}ff.", "token: token: abcdef1",
    f"PassWD={HEX}", "AKIA" + "B7" * 8, "AKIA" + "B7" * 7, f"API_KEY:\"{HEX}\" apikey= 'x'", "ſecret=abcdefgh",
    "a" * 30 + "g", "x" * 200_000 + f" secret={HEX}zz", f"{HEX}\n{HEX}", "toKen=K12345",
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, f"s{i}", "clash", 1) for i, t in enumerate(TEXTS)]
    rows += [(100, "bare Ab12Cd34Ef56Gh78Ij token", "s3", None, None), (3, TEXTS[3], "s3", None, None)]
    rows += [(200 + i, "password=ExampleKey12345678", f"o{i}", None, None) for i in range(5)]
    rows += [(300, "see ExampleKey12345678", None, None, None), (None, "secret=nullid99", None, None, None)]
    return S.judged(S.candidates(spark.createDataFrame(rows, DOCS))).collect()


def test_base_spans(found):
    for r in found:
        if r["id"] is not None and r["id"] < 100:
            base = [s for s in r["spans"] if s["kind"] != "reuse"]
            assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in base) == brute(TEXTS[r["id"]])


def test_ownership_and_reuse(found):
    by = {}
    for r in found:
        by.setdefault(r["id"], []).append(r["spans"])
    assert len(by[3]) == 2 and by[3][0] == by[3][1]            # repeated rows
    assert [(s["kind"], s["live"]) for s in by[100][0]] == [("reuse", True)]
    assert all(not s["live"] for s in by[200][0])              # five owners: copied
    assert by[300] == [[]]                                     # bare use of a copied value
    assert len(by[None][0]) == 1


def test_masking_keeps_other_rows_and_columns(spark):
    rows = [(1, "é token='Zx90Zx90Zx90' end", "a", "p", 1), (2, "clean", "b", "q", 2), (3, None, None, None, None),
            (2, "clean", "b", "q", 2)]
    df = spark.createDataFrame(rows, DOCS)
    out = S.mask_live(df)
    assert out.columns == df.columns
    got = sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0], str(r[1])))
    assert got == [(1, "é token='[SECRET]' end", "a", "p", 1), (2, "clean", "b", "q", 2), (2, "clean", "b", "q", 2),
                   (3, None, None, None, None)]


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert S.judged(S.candidates(df)).collect() == [] and S.mask_live(df).collect() == []


def test_query_digest(spark):
    from basinflow.llm.queries import QUERIES
    out = {r["doc_id"]: r for r in QUERIES["op6_secret_ownership"][0](spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert sum(r["n_assign"] for r in out.values()) > 0
    assert len(out) == len(docs)
    for d in docs:
        kinds = [x.split(":")[0] for x in brute(d["text"]).split(",") if x]
        for kind in ("assign", "access", "hex"):
            assert out[d["doc_id"]][f"n_{kind}"] == kinds.count(kind)
        assert out[d["doc_id"]]["base_sha256"] == hashlib.sha256(brute(d["text"]).encode()).hexdigest()


def test_one_owner_with_many_documents_is_live(spark):
    """Documents are no repositories: a value of one owner in many differing or
    equal texts is owner-specific, and its bare reuse is masked."""
    rows = [(i, f"text {i} password=Qw12Er34Ty56Ui78", "hot") for i in range(12)]
    rows += [(100 + i, "copy secret=Zx12Cv34Bn56Mk78", "hot") for i in range(12)]
    rows += [(200, "bare Qw12Er34Ty56Ui78 end", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = S.judged(S.candidates(df)).collect()
    assert all(s["live"] for r in got for s in r["spans"]) and all(len(r["spans"]) == 1 for r in got)
    masked = [r["text"] for r in S.mask_live(df).collect()]
    assert not any("Qw12" in t or "Zx12" in t for t in masked) and "bare [SECRET] end" in masked
    # Where the table has repositories, their number still decides; equal texts count once.
    repos = df.withColumn("repo", F.concat(F.lit("r"), F.col("doc_id")))
    live = {r["id"]: [s["live"] for s in r["spans"]] for r in S.judged(S.candidates(repos, repo_col="repo")).collect()}
    assert live[0] == [False] and live[100] == [True]


def test_short_and_padded_values_are_found_bare(spark):
    """Values of six characters on, with full stops and padding; words that
    many owners use bare stay although one text names them."""
    rows = [(1, "password = Zx9kQ2pL", "a"), (2, "see Zx9kQ2pL.", "a"), (3, "k=Zx9kQ2pL now", "a"), (4, "xZx9kQ2pL Zx9kQ2pLx", "a"),
            (5, "token: abcd1234efgh5678.ijkl==", "b"), (6, "(abcd1234efgh5678.ijkl==), abcd1234efgh5678.ijkl", "b"),
            (7, "secret=letters", "c"), *[(20 + k, "few letters here", f"o{k}") for k in range(4)],
            (8, "secret=abc12", "a"), (9, "abc12 abc12", "a"), (10, "====" * 50_000 + " Zx9kQ2pL", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in S.mask_live(df).collect()}
    assert got[1] == "password = [SECRET]" and got[2] == "see [SECRET]." and got[3] == "k=[SECRET] now"
    assert got[4] == rows[3][1] and got[10].endswith(" [SECRET]")
    assert got[6] == "([SECRET]==), [SECRET]" and got[5].startswith("token: [SECRET]")
    assert got[7] == "secret=letters" and got[20] == "few letters here" and got[9] == "abc12 abc12"


def test_bitmap_marks_every_named_value(spark):
    texts = [f"password=val{k:05d}x" for k in range(3000)]
    bits = S.named_values(spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(3))
    values = [t.split("=")[1].encode() for t in texts]
    ends = S.np.cumsum([len(v) for v in values])
    at = S._slots(S.T.hash_spans(S.np.frombuffer(b"".join(values), S.np.uint8), S.np.concatenate([[0], ends[:-1]]), ends))
    assert all(S.np.unpackbits(bits)[at]) and S.np.unpackbits(bits).sum() == len(set(at.tolist()))
