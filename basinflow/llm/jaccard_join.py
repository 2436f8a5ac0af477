"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document's set is its distinct SHINGLE-word shingles.  Two documents link
when ``100 * intersection >= percent * union``.

1. Corpus-wide document frequencies order all shingles, rarest first.  Linked
   sets share one of their first ``n - ceil(n * percent / 100) + 1`` in that
   order, so only those are tile keys; one that no other document holds is
   no key, and a document whose whole prefix is such has no link at all.
2. Equal sets form a class; only its smallest id goes on.
3. A tile holds the classes with one key.  In each size band of it all
   classes are compared with the band's pivot (the class with the least share
   of shingles of its own, such as the original of many edited copies).
4. Classes linked so far carry one label.  Every pair in a tile that still has
   several labels and whose sizes may link is compared: a pair passes if bit
   counts of the signatures leave room for the overlap, which bounds it from
   above, and then by exact intersection of the sorted arrays.
5. Links are merged to components by alternating large and small stars.

No pair is lost to the components: what step 4 skips is already in one.  The
links themselves, all of them, are the output of ``links``.  Defined
results: texts are lower-cased (A-Z); with fewer words than SHINGLE the whole
sequence is the one shingle; without words the set is empty and links with
nothing; rows of a null id link with nothing; equal rows give equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from basinflow.llm import exchange as X
from basinflow.llm import textops as T
from basinflow.llm.store import cut

SHINGLE = 5
PERCENT = 80
SIGNATURE_BITS = 1024
TILE_ROWS = 2048        # classes of one tile, on average, before it is cut into lots
GROUP_ROWS = 20_000     # rows of mixed tiles that one task compares, on average
_LOW = np.uint64(0xFFFFFFFF)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int):
    """(row, hash) of the distinct shingles, sorted, and the size of each set."""
    low = T.lower_ascii(data)
    s, e, first = T.words(low, offs)
    h = T.hash_spans(low, s, e)
    n = np.diff(first)
    at, per = T.ngram_index(first, k)
    g = T.ngrams(h, k)
    row, keys = T.rows_of(per), g[at] if len(at) else np.zeros(0, np.uint64)
    for m in range(1, k):
        short = np.flatnonzero(n == m)
        if len(short):
            whole = T.ngrams(h, m)[first[short]] + np.uint64(m)
            row, keys = np.concatenate([row, short]), np.concatenate([keys, T.mix64(whole)])
    order = np.lexsort((keys, row))
    row, keys = row[order], keys[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])
    row, keys = row[new], keys[new]
    return row, keys, np.bincount(row, minlength=len(n))


def _asked(keys: np.ndarray, buckets: int):
    """Distinct (bucket, lower half) keys, their counts, each entry's number."""
    full = X.bucket_of(keys, buckets) << np.uint64(32) | keys & _LOW
    distinct, inv, count = np.unique(full, return_inverse=True, return_counts=True)
    return distinct, inv, count


def _ask_frequency(k: int, buckets: int):
    def questions(b: X.Batch):
        _, keys, _ = shingle_sets(b.data, b.offs, k)
        distinct, _, count = _asked(keys, buckets)
        for bucket, i, j in X.by_bucket(distinct >> np.uint64(32)):
            yield bucket, distinct[i:j].astype("<u4").tobytes() + np.minimum(count[i:j], 255).astype(np.uint8).tobytes()
    return questions


def _frequencies(blobs: list[bytes]) -> list[bytes]:
    """Documents that hold each hash (at most 255, which orders it enough)."""
    n = [len(x) // 5 for x in blobs]
    hashes = np.concatenate([np.frombuffer(x, "<u4", m) for x, m in zip(blobs, n, strict=True)])
    counts = np.concatenate([np.frombuffer(x, np.uint8, offset=4 * m) for x, m in zip(blobs, n, strict=True)])
    distinct, inv = np.unique(hashes, return_inverse=True)
    total = np.minimum(np.bincount(inv, counts, len(distinct)), 255).astype(np.uint8)[inv]
    return [part.tobytes() for part in np.split(total, np.cumsum(n)[:-1])]


SETS = ("doc_id long, n_shingles long, class_a long, class_b long, alone double, "
        "prefix array<long>, signature array<long>, shared binary, n_shared int")


def _signature(h: np.ndarray) -> np.ndarray:
    bits = np.zeros(SIGNATURE_BITS, np.uint8)
    bits[(h % np.uint64(SIGNATURE_BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view("<i8")


def _describe(k: int, percent: int, buckets: int):
    def use(b: X.Batch, replies: dict[int, bytes]) -> pa.Table:
        row, keys, n = shingle_sets(b.data, b.offs, k)
        distinct, inv, _ = _asked(keys, buckets)
        freq = np.zeros(len(distinct), np.uint8)
        for bucket, i, j in X.by_bucket(distinct >> np.uint64(32)):
            freq[i:j] = np.frombuffer(replies[bucket], np.uint8, j - i)
        freq = freq[inv]
        with np.errstate(over="ignore"):
            ends, mixed = np.cumsum(n), T.mix64(keys ^ np.uint64(0x9E3779B97F4A7C15))
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (mixed, T.mix64(mixed))]
            a, c = ((x[ends] - x[ends - n]).view(np.int64) for x in sums)
        shared = freq > 1
        n_shared = np.bincount(row[shared], minlength=len(n))
        prefix = n - -(-n * percent // 100) + 1
        room = prefix - (n - n_shared)          # prefix places left to shared shingles
        null = b.ids.is_null().to_numpy()
        live = (room > 0) & (n_shared > 0) & ~null
        pre, sig, arr = [None] * len(n), [None] * len(n), [None] * len(n)
        for i in np.flatnonzero(live).tolist():
            part = slice(ends[i] - n[i], ends[i])
            mine = shared[part]
            h, f = keys[part][mine], freq[part][mine]
            pre[i] = h[np.lexsort((h, f))[:room[i]]].view(np.int64)
            sig[i], arr[i] = _signature(h), h.astype("<u8").tobytes()
        return pa.table({
            "doc_id": b.ids, "n_shingles": pa.array(n, pa.int64()), "class_a": pa.array(a), "class_b": pa.array(c),
            "alone": pa.array((n - n_shared) / np.maximum(n, 1)), "prefix": pa.array(pre, pa.list_(pa.int64())),
            "signature": pa.array(sig, pa.list_(pa.int64())), "shared": pa.array(arr, pa.binary()),
            "n_shared": pa.array(n_shared, pa.int32())})
    return use


def sets(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col="doc_id", text_col="text", **sizes) -> DataFrame:
    """One row per document: size, class of its set, and, where it may have a
    link, its prefix keys, signature and the shingles others hold too."""
    c = X.chunked(docs, id_col, text_col, **sizes)
    freq = X.answer(c.ask(_ask_frequency(k, c.buckets)), _frequencies)
    return cut(c.with_answers(freq, _describe(k, percent, c.buckets), SETS), "sets")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ends of ``links`` (a, b): the smallest id that
    links reach.  Every round is written to the shared folder."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def stars(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        near = both.join(least, "u")
        out = near.where(F.lit(small) | (F.col("v") > F.col("u"))).select(F.col("v").alias("u"), F.col("m").alias("v"))
        if small:
            out = out.unionByName(least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame):
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    now = mark(edges)
    while now[0]:
        edges = cut(stars(stars(edges, False), True), "edges")
        before, now = now, mark(edges)
        if now == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _tile_pairs(percent: int):
    """Pairs of one batch of tiles that the bit counts cannot rule out.

    A tile's rows are its own band's classes (``guest`` 0) and the next smaller
    band's (1).  Rows of equal label or of sizes that cannot link are no pair.
    Elements of one set whose bit the other lacks are outside it, so the bit
    counts bound the overlap from above."""
    def tile(rows):
        own = np.flatnonzero(rows["guest"] == 0)
        out = []
        for i in range(0, len(own), 256):
            left = own[i:i + 256]
            right = np.arange(len(rows["id"]))
            fit = ((rows["component"][left][:, None] != rows["component"][right])
                   & ((rows["guest"][right] == 1) | (left[:, None] < right))
                   & ((rows["lot"][left][:, None] == rows["lot_a"][0]) & (rows["lot"][right] == rows["lot_b"][0])
                      | (rows["lot"][left][:, None] == rows["lot_b"][0]) & (rows["lot"][right] == rows["lot_a"][0])))
            n, m = rows["n_shingles"][left][:, None], rows["n_shingles"][right]
            fit &= np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
            x, y = np.nonzero(fit)
            x, y = left[x], right[y]
            for j in range(0, len(x), 1 << 16):
                p, q = x[j:j + (1 << 16)], y[j:j + (1 << 16)]
                sp, sq = rows["signature"][p], rows["signature"][q]
                most = np.minimum(rows["n_shared"][p] - np.bitwise_count(sp & ~sq).sum(1),
                                  rows["n_shared"][q] - np.bitwise_count(sq & ~sp).sum(1))
                ok = most * (100 + percent) >= (rows["n_shingles"][p] + rows["n_shingles"][q]) * percent
                out.append(np.stack([rows["id"][p[ok]], rows["id"][q[ok]]], 1))
        return out

    def pairs(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("key", "band", "lot_a", "lot_b", "id")])
        cols = {c: table.column(c).to_numpy().astype(np.int64) for c in table.column_names if c != "signature"}
        sig = table.column("signature").combine_chunks()
        cols["signature"] = sig.flatten().to_numpy().view(np.uint64).reshape(len(table), -1)
        edge = np.zeros(len(table), bool)
        for c in ("key", "band", "lot_a", "lot_b"):
            edge[1:] |= cols[c][1:] != cols[c][:-1]
        cut_at = [0, *np.flatnonzero(edge).tolist(), len(table)]
        found = [np.zeros((0, 2), np.int64)]
        for i, j in zip(cut_at, cut_at[1:], strict=False):
            if j - i > 1:
                found += tile({c: v[i:j] for c, v in cols.items()})
        got = np.unique(np.sort(np.concatenate(found), 1), axis=0)
        return pa.table({"a": got[:, 0], "b": got[:, 1]})
    return pairs


def _links_udf(percent: int):
    def links(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
        out = []
        for x, y, n, m in zip(a, b, na.to_pylist(), nb.to_pylist(), strict=True):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            if len(x) > len(y):
                x, y = y, x
            same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(y) else 0
            out.append(100 * same >= percent * (n + m - same))
        return pa.array(out, pa.bool_())
    return F.arrow_udf(links, BooleanType())


def _verified(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, by exact intersection."""
    arrays = reps.select("id", "n_shingles", "shared")
    left = arrays.toDF("a", "na", "xa")
    right = arrays.toDF("b", "nb", "xb")
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_links_udf(percent)("xa", "xb", "na", "nb")).select("a", "b")


def _banded(reps: DataFrame, percent: int) -> DataFrame:
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100 / percent) + 1e-9)).cast("int")
    return reps.withColumn("band", band)


def _groups(sizes: DataFrame) -> int:
    """Groups that the rows of all tiles are dealt to: a class of a tile of
    many lots has a row for each of them."""
    rows = sizes.agg(F.sum(F.col("m") * F.col("lots"))).first()[0] or 0
    return max(1, -(-rows // GROUP_ROWS))


def _candidate_pairs(side: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of ``side`` that share a key, differ in label and
    may link by size and bit counts.

    A pair meets in the band of its larger set: every class is also a guest one
    band up.  Tiles over TILE_ROWS are cut into lots by a hash of the id, and
    each two lots meet in a tile of their own, so no task holds a hot key whole."""
    tiles = (side.withColumn("guest", F.explode(F.array(F.lit(0), F.lit(1))))
             .withColumn("band", F.col("band") + F.col("guest")))
    sizes = (tiles.groupBy("key", "band").agg(F.count(F.lit(1)).alias("m"), F.min("guest").alias("g"))
             .where("m > 1 and g = 0").select("key", "band", "m", F.ceil(F.col("m") / TILE_ROWS).cast("int").alias("lots")))
    sizes = cut(sizes, "sizes")
    groups = _groups(sizes)
    tiles = tiles.join(sizes.drop("m"), ["key", "band"]).withColumn("lot", F.pmod(F.xxhash64("id"), F.col("lots")).cast("int"))
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    tiles = tiles.withColumns({"lot_a": F.least("lot", "other"), "lot_b": F.greatest("lot", "other")})
    dealt = tiles.select("key", "band", "lot_a", "lot_b", "lot", "guest", "id", "n_shingles", "n_shared", "component",
                         "signature", F.pmod(F.xxhash64("key", "band", "lot_a", "lot_b"), F.lit(groups)).cast("int").alias("grp"))
    dealt = dealt.repartition(groups, "grp")
    pairs = _tile_pairs(percent)
    return dealt.groupBy("grp").applyInArrow(lambda t: pairs(t.drop_columns("grp")), "a long, b long").distinct()


SAME = ["n_shingles", "class_a", "class_b"]


def _tiled(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, their representatives, the keys they share with others)."""
    named = rows.where(F.col("prefix").isNotNull())
    classes = cut(named.groupBy(*SAME).agg(F.min("doc_id").alias("id")), "classes")
    reps = cut(named.join(classes.withColumnRenamed("id", "doc_id"), [*SAME, "doc_id"], "left_semi")
               .dropDuplicates(["doc_id", *SAME]).withColumnRenamed("doc_id", "id"), "reps")
    slim = _banded(reps.select("id", "n_shingles", "n_shared", "alone", "prefix"), percent)
    tiles = slim.select("id", "n_shingles", "n_shared", "alone", "band", F.explode("prefix").alias("key"))
    # Tiles of one class have no pair.
    busy = tiles.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    return classes, reps, cut(tiles.join(busy, "key", "left_semi"), "tiles")


def links(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col="doc_id", text_col="text",
          **sizes) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): every link (a, b), a < b, between two classes of equal
    sets, once, and (doc_id, id) of the documents of each class.  Documents of
    one class link with each other, and with all of a class linked to theirs.

    Unlike ``join`` it compares every pair of a tile whose sizes may link, also
    of one component, so its cost follows the number of links."""
    rows = sets(docs, k, percent, id_col, text_col, **sizes)
    classes, reps, tiles = _tiled(rows, percent)
    side = (tiles.select("key", "id", "n_shingles", "n_shared", F.col("id").alias("component"), "band")
            .join(reps.select("id", "signature"), "id"))
    pairs = cut(_verified(_candidate_pairs(cut(side, "mixed"), percent), reps, percent), "links")
    members = rows.where(F.col("prefix").isNotNull()).join(classes, SAME).select("doc_id", "id")
    return pairs, members


def join(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col="doc_id", text_col="text", **sizes) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = sets(docs, k, percent, id_col, text_col, **sizes)
    classes, reps, tiles = _tiled(rows, percent)
    same = SAME

    pivots = tiles.groupBy("key", "band").agg(F.min(F.struct("alone", "id", "n_shingles")).alias("p"))
    first = (tiles.join(pivots, ["key", "band"])
             .where((F.col("id") != F.col("p.id")) & _sizes_fit(F.col("n_shingles"), F.col("p.n_shingles"), percent))
             .select(F.col("p.id").alias("a"), F.col("id").alias("b")).distinct())
    label = components(cut(_verified(first, reps, percent), "links"))

    labelled = tiles.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = (labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .where("x <> y").select("key"))
    side = (labelled.join(mixed, "key", "left_semi").select("key", "id", "n_shingles", "n_shared", "component", "band")
            .join(reps.select("id", "signature"), "id"))
    side = cut(side, "mixed")
    rest = _candidate_pairs(side, percent)
    more = cut(_verified(rest, reps, percent), "links")
    label = components(label.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))

    found = classes.join(label, "id", "left").select(*same, F.coalesce("component", "id").alias("component_id"))
    with_class = rows.where(F.col("prefix").isNotNull()).select("doc_id", *same).join(found, same)
    without = rows.where(F.col("prefix").isNull())
    return (with_class.select("doc_id", "n_shingles", "component_id")
            .unionByName(without.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))


def keep_first(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id.  Rows of a
    null id stay; of rows that share the smallest id, all stay."""
    found = join(docs.select(id_col, text_col), id_col=id_col, text_col=text_col, **how)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("_copy")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("_copy"), "left_anti")
