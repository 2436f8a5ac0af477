"""Document fingerprints: I-Match over randomised lexicon subsets.

Terms are the lower-cased words of a text.  The lexicon holds the terms whose
normalised inverse document frequency, ln(N / df) / ln(N), lies in a band, so
neither very common nor once-only terms count.  A text's distinct lexicon
terms are sorted, and several randomised subsets of the lexicon, from the
whole of it down to small fractions, are hashed: one part of the
fingerprint each.  Small subsets survive larger edits.  The likeness of two
fingerprints is the share of equal parts among those that either text fills.

Everything is DataFrame functions.  Documents are ordered within ranges of the
id and cut into chunks of bounded size.  A chunk asks each of its distinct
terms once; a term's own group adds up its document frequency and answers the
asking chunks if it is in the band; a chunk gets its known terms as one row, by
which its documents' terms are filtered.  The texts are shuffled once.  A group
of a term holds one row a chunk.

Defined results: null text is empty; a text without a lexicon term has the
hash of the whole text as its fingerprint, alike only to an equal text; rows
of a null id come last in descending order; rows of equal id are ordered by
the hash of their text; equal rows give equal results; other columns are not
read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinflow.llm.store import aligned_joins

BAND = (0.2, 0.95)           # normalised inverse document frequency
# Subsets of the lexicon: all of it, 4 disjoint quarters, 8 sixteenths within
# them, and within each of these a 64th and a 128th.  A term's hash draws its
# subsets.  An edit leaves a subset alone if none of its terms changes: large
# ones tell copies from near copies, small ones still agree when half of a text
# is new.
PARTS = 1 + 4 + 8 + 8 + 8
ROWS_PER_BUCKET = 4096
MAX_BUCKETS = 10_000        # ranges of the id; beyond it they grow, and hold several chunks
CHUNK_ROWS = 4096
SPREAD = 128                # its square: lists that a chunk's known terms are dealt into
LEAST = -(1 << 63)
ROW, GHOST, NO_ID = 0, 1, 2  # kinds of rows: with an id, of the next bucket, without an id


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.split(F.lower(text), r"[\x20\x09-\x0D]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``key``: first among every
    ``step``-th bound, then among those between."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    heads = bounds[::step]
    runs = [bounds[i + 1:i + step] for i in range(0, len(bounds), step)]

    def many(xs):
        return "array(" + ",".join(f"{x}L" for x in xs) + ")" if xs else "cast(array() as array<bigint>)"

    coarse = F.size(F.filter(F.expr(many(heads)), lambda b: b <= key))
    inner = F.element_at(F.expr("array(" + ",".join(many(r) for r in runs) + ")"), F.greatest(coarse, F.lit(1)))
    fine = F.size(F.filter(inner, lambda b: b <= key))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + 1 + fine).cast("int")


def in_chunks(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, int, int]:
    """``docs`` (key, text, kind) in descending key order with the next row's
    text (after the last comes the first), by bucket, chunk and place; the
    numbers of rows and buckets.

    Each chunk ends with the next chunk's first row (``extra``).  For that, the
    first row of each bucket is also sent to the bucket above it."""
    n = docs.count()
    buckets = min(MAX_BUCKETS, max(1, math.ceil(n / rows_per_bucket)))
    bounds = []
    if buckets > 1:
        marks = F.percentile_approx("key", [k / buckets for k in range(1, buckets)], 10 * buckets)
        bounds = sorted({x for x in docs.agg(marks.alias("q")).first()["q"]})
    ranged = docs.withColumn("bucket", _bucket(F.col("key"), bounds))
    first = F.max(F.struct("key", F.bitwise_not(F.xxhash64("text")).alias("h")))
    tops = sorted(tuple(r) for r in ranged.groupBy("bucket").agg(first.alias("top")).select("bucket", "top.*").collect())
    sent = [(key, h, above[0]) for (_, key, h), above in zip(tops, [*tops[1:], *tops[:1]], strict=True)]
    sent = F.broadcast(docs.sparkSession.createDataFrame(sent, "key long, h long, bucket int"))     # one row a bucket
    ghosts = (docs.withColumn("h", F.bitwise_not(F.xxhash64("text"))).join(sent, ["key", "h"])
              .groupBy("bucket").agg(F.max("key").alias("key"), F.max("text").alias("text"))      # equal rows become one
              .select("key", "text", F.lit(GHOST).alias("kind"), "bucket"))
    every = ranged.unionByName(ghosts).repartition(buckets, "bucket")
    order = Window.partitionBy("bucket").orderBy(F.col("kind") == GHOST, F.desc("key"), F.xxhash64("text"))
    lined = every.withColumns({"next_text": F.lead("text").over(order), "pos": F.row_number().over(order) - 1})
    ghost = F.col("kind") == GHOST
    chunk = F.expr(f"cast(pos div {chunk_rows} as int)")

    def at(c, extra):
        return F.struct(c.alias("chunk"), F.lit(extra).alias("extra"))

    places = (F.when(ghost, F.array(at(F.expr(f"cast((pos - 1) div {chunk_rows} as int)"), True)))
              .when((F.col("pos") % chunk_rows == 0) & (F.col("pos") > 0), F.array(at(chunk, False), at(chunk - 1, True)))
              .otherwise(F.array(at(chunk, False))))
    return lined.select("*", F.explode(places).alias("at")).select("*", "at.*").drop("at"), n, buckets


def edited(text: Column, following: Column) -> Column:
    """``text`` whose last half (rounded down) is the first as many code
    points, or all, of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(following, F.lit(1), half))


def known_terms(rows: DataFrame, n_docs: int, buckets: int, band=BAND) -> DataFrame:
    """(bucket, chunk, known): the chunk's terms in the band, dealt into lists.

    ``rows`` (bucket, chunk, extra, own, edited) are partitioned by bucket, so
    a chunk's distinct terms are found where they are; each makes one row."""
    mine = F.transform("own", lambda h: F.struct(h.alias("h"), F.when(F.col("extra"), 0).otherwise(1).alias("n")))
    new = F.transform(F.array_except("edited", "own"), lambda h: F.struct(h.alias("h"), F.lit(0).alias("n")))
    asked = (rows.select("bucket", "chunk", F.explode(F.concat(mine, new)).alias("x")).select("bucket", "chunk", "x.*")
             .groupBy("bucket", "chunk", "h").agg(F.sum("n").alias("n")))
    size = max(n_docs, 2)
    low, high = max(size ** (1 - band[1]), 2), size ** (1 - band[0])
    found = (asked.groupBy("h").agg(F.sum("n").alias("df"), F.collect_list(F.struct("bucket", "chunk")).alias("at"))
             .where((F.col("df") >= low) & (F.col("df") <= high)).select("h", F.explode("at").alias("at"))
             .select("at.*", "h").repartition(buckets, "bucket"))
    k1, k2 = _lists("h")
    lists = found.groupBy("bucket", "chunk", k1.alias("k1"), k2.alias("k2")).agg(F.collect_list("h").alias("hs"))
    lists = lists.groupBy("bucket", "chunk", "k1").agg(F.map_from_entries(F.collect_list(F.struct("k2", "hs"))).alias("m"))
    known = lists.groupBy("bucket", "chunk").agg(F.map_from_entries(F.collect_list(F.struct("k1", "m"))).alias("m"))
    every = F.sequence(F.lit(0), F.lit(SPREAD - 1))
    return known.select("bucket", "chunk", F.transform(every, lambda a: F.transform(every, lambda b: F.col("m")[a][b])).alias("known"))


def _lists(h) -> tuple[Column, Column]:
    """Which list of a chunk a term is in."""
    return F.pmod(h, F.lit(SPREAD)).cast("int"), F.pmod(F.shiftright(h, 20), F.lit(SPREAD)).cast("int")


def parts(sorted_terms: Column) -> Column:
    """Hash of each lexicon subset's terms; empty where it holds none."""
    def part(arr):
        return F.when(F.size(arr) == 0, F.lit("")).otherwise(F.hex(F.pmod(F.xxhash64(arr), F.lit(1 << 40))))

    def where(arr, place, bits, value):
        return F.filter(arr, lambda h: F.shiftright(h, place).bitwiseAND(F.lit((1 << bits) - 1)) == value)

    def with_smaller(sixteenth):
        return F.flatten(F.transform(F.array(where(sixteenth, 47, 2, 0)),
                                     lambda x: F.array(part(sixteenth), part(x), part(where(x, 46, 1, 0)))))

    def with_sixteenths(quarter):
        two = F.array(where(quarter, 49, 2, 0), where(quarter, 49, 2, 1))
        return F.concat(F.array(part(quarter)), F.flatten(F.transform(two, with_smaller)))

    quarters = F.array(*[where(sorted_terms, 51, 2, k) for k in range(4)])
    return F.concat(F.array(part(sorted_terms)), F.flatten(F.transform(quarters, with_sixteenths)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those that either side fills."""
    def count(test):
        def one(x, y):
            return test(F.coalesce(x, F.lit("")), F.coalesce(y, F.lit(""))).cast("int")
        return F.aggregate(F.zip_with(a, b, one), F.lit(0), lambda s, x: s + x)

    same = count(lambda x, y: (x == y) & (x != ""))
    filled = count(lambda x, y: (x != "") | (y != ""))
    return F.when(filled == 0, F.lit(0.0)).otherwise(same / F.greatest(filled, F.lit(1)))


def compare_neighbours(docs: DataFrame, id_col="doc_id", text_col="text", band=BAND, **sizes) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and the
    likeness to the edited text's and the next document's."""
    aligned_joins(docs.sparkSession)
    key = F.col(id_col).cast("long")
    keyed = docs.select(F.coalesce(key, F.lit(LEAST)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.when(key.isNull(), NO_ID).otherwise(ROW).alias("kind"))
    lined, n, buckets = in_chunks(keyed, **sizes)
    made = lined.withColumn("edited", F.when(F.col("extra"), "").otherwise(edited(F.col("text"), F.col("next_text"))))
    rows = made.select(
        "bucket", "chunk", "pos", "extra", F.when(F.col("kind") != NO_ID, F.col("key")).alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.xxhash64("text").alias("hash_own"), F.xxhash64("edited").alias("hash_edited"),
        terms(F.col("text")).alias("own"), terms(F.col("edited")).alias("edited"))
    facts = ["pos", "extra", "doc_id", "n_chars", "edited_sha256", "hash_own", "hash_edited"]
    chunks = rows.groupBy("bucket", "chunk").agg(F.collect_list(F.struct(*facts, "own", "edited")).alias("docs"))
    chunks = chunks.join(known_terms(rows, n, buckets, band), ["bucket", "chunk"], "left")

    def known(found):
        def has(h):
            k1, k2 = _lists(h)
            return F.coalesce(F.array_contains(F.col("known")[k1][k2], h), F.lit(False))
        return F.sort_array(F.filter(found, has))

    each = chunks.select("bucket", "chunk", F.explode(F.transform(
        "docs", lambda d: F.struct(*[d[c].alias(c) for c in facts], known(d["own"]).alias("own"), known(d["edited"]).alias("edited")))).alias("d"))
    each = each.select("bucket", "chunk", "d.*")

    def printed(kind):
        whole = F.array(F.concat(F.lit("text:"), F.hex(F.col(f"hash_{kind}"))))
        return F.when(F.size(kind) == 0, whole).otherwise(parts(F.col(kind)))

    each = each.select("bucket", "chunk", *facts, printed("own").alias("parts_own"), printed("edited").alias("parts_edited"))
    following = F.lead("parts_own").over(Window.partitionBy("bucket", "chunk").orderBy("pos"))
    out = each.withColumn("parts_next", following).where(~F.col("extra"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("parts_own", ".").alias("fingerprint"),
        F.array_join("parts_edited", ".").alias("edited_fingerprint"),
        likeness(F.col("parts_own"), F.col("parts_edited")).alias("near_edited"),
        likeness(F.col("parts_own"), F.col("parts_next")).alias("near_next"))
