"""Secret scans with corpus-wide ownership frequency.

Every whole text is searched for three kinds of secret (``assign``,
``access``, ``hex``) and for bare tokens that could be the value of one.  The
hashes of all values are aggregated over the corpus by distinct owner and
repository.  A value that many owners or repositories hold is a widely copied
example (``copied``); one that few hold is owner-specific and looks ``live``.
Equal texts of one owner count as one repository, and where the repository is
only the document id (the default), owners alone decide: one owner's documents
grow with the corpus.
A bare token whose value is a live secret found elsewhere becomes a further
span of kind ``reuse``: the values that any text names are marked in a bitmap
of fixed size, a second pass over the texts keeps the tokens it marks, and the
aggregation by the whole value decides.  Full stops and equals signs at the end
of a value or token do not count; of ``name=value`` both the whole and what
follows the last equals sign are tried.

Defined results: null text is empty and has no span; a null owner or
repository counts as one value of its own; equal rows get equal results, each
on its own; offsets are code points, the end is exclusive.  Other columns pass
through untouched whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from basinflow.llm import textops as T
from basinflow.llm.store import batch_rows, cut

# The kinds, in the order that breaks ties, and their patterns.
KINDS = ["assign", "access", "hex", "reuse"]
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_BARE = 6, 20, 24, 6

MAX_OWNERS = 2      # more owners than this: a copied example
MAX_REPOS = 8       # more repositories than this: a copied example, where the table has repositories
MAP_BITS = 26       # bits of a hash that the bitmap of named values keeps (8 MiB)
PAGE_BITS = 13
SMALL_ROWS = 100_000    # rows with live spans that may be broadcast

_any_case = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in KEYWORDS)
_ASSIGN = re.compile(rf"({_any_case})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_BARE = re.compile(r"[A-Za-z0-9+/_.=-]+")

# A text without any of these byte strings has no assign and no access match.
_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key", b"akia")


def _members(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_IS_HEX = _members("0123456789abcdef")
_IS_BARE = _members(_LETTERS + "0123456789+/_.=-")
_IS_END = _members(".=")

_FOUND = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
    StructField("value_start", LongType()), StructField("value", StringType())]))


def _value(text: str) -> str:
    return hashlib.sha256(text.rstrip(".=").encode()).hexdigest()[:32]


def _named(text: str) -> list[tuple]:
    """(kind, start, end, start of the value, value) of the base matches, by start."""
    out = [("assign", *m.span(), m.start(2), m[2]) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    out += [("access", *m.span(), m.start(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [("hex", *m.span(), m.start(), m[0]) for m in _HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def find(text: str, wanted=frozenset()) -> list[tuple]:
    """(kind, start, end, start of the value, hash of the value), by start:
    base matches, and bare tokens among ``wanted`` that lie outside them."""
    out = _named(text)
    taken = sorted((a, b) for _, a, b, _, _ in out)
    bare, k = [], 0
    for m in _BARE.finditer(text) if wanted else ():
        token, a = m[0].rstrip(".="), m.start()
        last = a + token.rfind("=") + 1
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        for start in (a, last) if last > a else (a,):
            value, end = token[start - a:], a + len(token)
            if value in wanted and not any(s < end and e > start for s, e in taken[k:k + 3]):
                bare.append(("reuse", start, end, start, value))
                break
    return sorted([(*x, _value(v)) for *x, v in out + bare], key=lambda x: (x[1], KINDS.index(x[0])))


def _runs(mask: np.ndarray, offs: np.ndarray, least: int):
    """Starts and ends of runs of at least ``least`` bytes within a document."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[1:-1] = mask[1:] != mask[:-1]
    edge[0] = edge[-1] = True
    edge[offs] = True
    at = np.flatnonzero(edge)
    s, e = at[:-1], at[1:]
    long = (e - s >= least) & mask[s]
    return s[long], e[long]


def _suspects(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows that may hold a base match (no row with one is missed)."""
    if not len(data):
        return np.zeros(0, np.int64)
    at = [_runs(_IS_HEX[data], offs, MIN_HEX)[0]]
    low = T.lower_ascii(data).tobytes()
    for hint in _HINTS:
        at.append(np.array([m.start() for m in re.finditer(re.escape(hint), low)], np.int64))
    at = np.concatenate(at).astype(np.int64)
    return np.unique(np.searchsorted(offs, at, "right") - 1)


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the bare tokens, and of what follows a last ``=``."""
    s, e = _runs(_IS_BARE[data], offs, MIN_BARE)
    if not len(s):
        return s, e
    place = np.arange(len(data))
    e = np.maximum(np.maximum.accumulate(np.where(_IS_END[data], -1, place))[e - 1] + 1, s)
    last = np.maximum.accumulate(np.where(data == 61, place, -1))[np.maximum(e - 1, 0)] + 1
    inner = last > s
    s, e = np.concatenate([s, last[inner]]), np.concatenate([e, e[inner]])
    long = e - s >= MIN_BARE
    return s[long], e[long]


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def named_values(docs: DataFrame, text_col="text") -> np.ndarray:
    """Bitmap (2 ** MAP_BITS bits) of the hashes of all values that any text
    names; at most 2 ** (MAP_BITS - PAGE_BITS) pages come to the driver."""
    def mark(batches):
        marked = np.zeros(1 << MAP_BITS, bool)
        for b in batches:
            for _, _, data, offs in T.text_slices(b.column("text")):
                values = [v.rstrip(".=").encode() for r in _suspects(data, offs)
                          for *_, v in _named(data[offs[r]:offs[r + 1]].tobytes().decode())]
                if values:
                    ends = np.cumsum([len(v) for v in values])
                    flat = np.frombuffer(b"".join(values), np.uint8)
                    marked[_slots(T.hash_spans(flat, np.concatenate([[0], ends[:-1]]), ends))] = True
        pages = np.packbits(marked).reshape(-1, 1 << (PAGE_BITS - 3))
        used = np.flatnonzero(pages.any(1))
        yield pa.RecordBatch.from_pydict({"page": pa.array(used, pa.int32()), "bits": pa.array([pages[k].tobytes() for k in used], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("bits")])
        return pa.table({"page": table.column("page").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    batch_rows(docs.sparkSession)
    schema = "page int, bits binary"
    out = np.zeros((1 << (MAP_BITS - PAGE_BITS), 1 << (PAGE_BITS - 3)), np.uint8)
    texts = docs.select(F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    for r in texts.mapInArrow(mark, schema).groupBy("page").applyInArrow(add, schema).toLocalIterator():
        out[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _scan_udf(bitmap):
    def scan(text: pa.Array) -> pa.Array:
        bits, counts, found = bitmap.value, np.zeros(len(text), np.int64), []
        for i, _, data, offs in T.text_slices(text):
            s, e = _tokens(data, offs)
            at = _slots(T.hash_spans(data, s, e))
            hit = np.flatnonzero(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
            wanted = {}
            for r, a, b in zip((np.searchsorted(offs, s[hit], "right") - 1).tolist(), s[hit].tolist(), e[hit].tolist(), strict=True):
                wanted.setdefault(r, set()).add(data[a:b].tobytes().decode())
            for r in sorted({*_suspects(data, offs).tolist(), *wanted}):
                got = find(data[offs[r]:offs[r + 1]].tobytes().decode(), wanted.get(r, ()))
                counts[i + r] = len(got)
                found += got
        names = ["kind", "start", "end", "value_start", "value"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        items = pa.StructArray.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(kinds)], names)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), items)
    return F.arrow_udf(scan, _FOUND).asNondeterministic()


def candidates(docs: DataFrame, id_col="doc_id", text_col="text", owner_col="source", repo_col: str | None = None) -> DataFrame:
    """One row per input row: rid, id, owner, repo, found (written once).
    Without ``repo_col`` every id is a repository of its own, of any number of
    which one owner may hold a value."""
    bitmap = docs.sparkSession.sparkContext.broadcast(named_values(docs, text_col))      # 8 MiB
    return cut(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                           F.col(owner_col).cast("string").alias("owner"), F.col(repo_col or id_col).cast("string").alias("repo"),
                           F.lit(_repos(repo_col, id_col)).alias("has_repos"),
                           F.xxhash64(text_col).alias("text_hash"), _scan_udf(bitmap)(F.col(text_col)).alias("found")), "secrets")


def _repos(repo_col: str | None, id_col: str) -> bool:
    return repo_col is not None and repo_col != id_col


def ownership(cands: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """(value, n_owners, n_repos, live) over the whole corpus; ``n_repos``
    counts a group of equal texts of one owner once.

    Occurrences are combined before each shuffle, first on (value, owner,
    text, repository), so a value that a third of all rows hold stays spread."""
    seen = cands.select("owner", "repo", "has_repos", "text_hash", F.explode("found").alias("f"))
    # Of equal texts the smallest repository stands for all.
    per_text = (seen.groupBy(F.col("f.value").alias("value"), "owner", "text_hash")
                .agg(F.min("repo").alias("repo"), F.max("has_repos").alias("has_repos"),
                     F.max((F.col("f.kind") != "reuse").cast("int")).alias("named")))
    per_repo = per_text.groupBy("value", "owner", "repo").agg(F.max("has_repos").alias("has_repos"), F.max("named").alias("named"))
    per_owner = (per_repo.groupBy("value", "owner")
                 .agg(F.count(F.lit(1)).alias("repos"), F.max("has_repos").alias("has_repos"), F.max("named").alias("named")))
    return (per_owner.groupBy("value")
            .agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.max("has_repos").alias("has_repos"),
                 F.max("named").alias("named"))
            .where("named = 1")
            .select("value", "n_owners", "n_repos",
                    ((F.col("n_owners") <= max_owners) & (~F.col("has_repos") | (F.col("n_repos") <= max_repos))).alias("live")))


def judged(cands: DataFrame, **bounds) -> DataFrame:
    """``candidates`` with ``spans``: found spans and their verdict; bare
    tokens stay only where their value is a live secret."""
    each = cands.select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    kept = (each.join(ownership(cands, **bounds), "value")
            .where((F.col("kind") != "reuse") | F.col("live"))
            .groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
                "start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank"),
                "kind", "end", "value_start", "live", "n_owners", "n_repos"))).alias("spans")))
    empty = F.lit([]).cast(kept.schema["spans"].dataType)
    return (cands.drop("found", "has_repos").join(kept, "rid", "left").withColumn("spans", F.coalesce("spans", empty)))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@F.arrow_udf(StringType())
def _mask_udf(text: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    out = []
    for t, ss, es in zip(text.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True):
        at, parts = 0, []
        for s, e in zip(ss or [], es or [], strict=True):
            if e > at:
                parts += [t[at:max(s, at)], "[SECRET]"]
                at = e
        out.append(t if not parts else "".join(parts) + t[at:])
    return pa.array(out, pa.string())


def mask_live(docs: DataFrame, id_col="doc_id", text_col="text", owner_col="source", repo_col: str | None = None,
              length_col: str | None = None, **bounds) -> DataFrame:
    """``docs`` with the value of each live-looking secret, and of each reuse
    of one, replaced; copied examples and texts without a secret stay.  The
    spans of at most SMALL_ROWS rows with a live span are broadcast, so the texts
    are not moved; those of more are joined by id and text.  ``length_col`` is
    set to the new length."""
    cols = docs.columns
    cands = candidates(docs, id_col, text_col, owner_col, repo_col)
    live = (judged(cands, **bounds).select("id", "text_hash", F.filter("spans", lambda s: s["live"]).alias("_spans"))
            .where(F.size("_spans") > 0).dropDuplicates(["id", "text_hash"])
            .select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "_spans"))
    live = cut(live, "live")
    if live.count() <= SMALL_ROWS:
        live = F.broadcast(live)
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(cols)])
    c = {name: f"c{k}" for k, name in enumerate(cols)}
    out = keyed.join(live, F.col(c[id_col]).eqNullSafe(F.col("_id")) & (F.xxhash64(c[text_col]) == F.col("_hash")), "left")
    masked = _mask_udf(F.col(c[text_col]), F.col("_spans.value_start"), F.col("_spans.end"))
    text = F.when(F.col("_spans").isNull(), F.col(c[text_col])).otherwise(masked)
    out = out.withColumn(c[text_col], text)
    if length_col:
        out = out.withColumn(c[length_col], F.when(F.col("_spans").isNull(), F.col(c[length_col]))
                             .otherwise(F.length(c[text_col]).cast(docs.schema[length_col].dataType)))
    return out.select(*[F.col(f"c{k}").alias(name) for k, name in enumerate(cols)])
