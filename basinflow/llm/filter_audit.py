"""Filter interaction audit with radix text tries.

Five filters fail a document: A few words, B few distinct words, C many
capitals, D listed symbols, E a text equal to that of a smaller id anywhere in
the table.  For every order in which the filters can be applied the audit says
what each step keeps, removes, finds already removed and costs in labelled
documents, and each filter's Shapley share.

E comes from compressed tries.  Each task first inserts its texts into a trie
of its own (bounded in bytes), whose terminals hold the least id, so copies
meet before anything is moved.  What is left is range-partitioned by adaptive
prefixes: a prefix is lengthened while the texts that begin with it are more
than a share of one range.  One trie a range then takes the whole texts as a
stream, whatever the number of copies, and its terminals name the document
that each text belongs to first.  A to D are bits of the text alone.  Masks are
reduced to counts per part and mask before any order is looked at.

Defined results: a null text is empty; a null source is the part ''; a null id
is never a duplicate nor makes one; rows of the same id and text are all
counted and none is smaller than another; several labels of one id count as
1 where any is 1; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from basinflow.llm import textops as T
from basinflow.llm.store import batch_rows, cut

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
MIN_WORDS = 200
MIN_DISTINCT = 50            # per cent of the words
MAX_CAPITALS = 2             # per cent of the code points
SYMBOLS = "#$%&*|"           # fixed values
LOCAL_BYTES = 32 << 20       # texts of a task's own trie before it is emptied
RANGE_BYTES = 16 << 20       # texts of one range, on average
FIRST_PREFIX = 16            # bytes; four times as many at each lengthening
LEAST_HEAVY = 1 << 20

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


class Trie:
    """Compressed trie; a node is [label, children by first byte, held]."""

    def __init__(self):
        self.root, self.size = [b"", {}, None], 0

    def insert(self, text: bytes, held: tuple) -> None:
        """Put ``text``; its terminal keeps the smaller of the tuples."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, None]
                self.size += len(text) - at
                node = child
                break
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k = _common(label, text, at)
            fork = [label[:k], {label[k]: child}, None]
            child[0] = label[k:]
            node[1][text[at]] = fork
            node, at = fork, at + k
        if node[2] is None or held < node[2]:
            node[2] = held

    def terminals(self):
        stack = [self.root]
        while stack:
            _, children, held = stack.pop()
            if held is not None:
                yield held
            stack += children.values()


def _common(label: bytes, text: bytes, at: int) -> int:
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if text.startswith(label[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low


def _rows(found, keep_text: bool):
    """Batches of the terminals' (id, hash[, text])."""
    names = ["id", "h", "text"] if keep_text else ["id", "h"]
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    for some in itertools.batched(found, 2000):
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in some], kinds[k]) for k in range(len(names))], names)


def _inserted(limit: int | None, keep_text: bool):
    def run(batches):
        trie = Trie()
        for b in batches:
            for i, h, text in zip(*(b.column(k).to_pylist() for k in ("id", "h", "text")), strict=True):
                trie.insert(text, (i, h, text) if keep_text else (i, h))
                if limit and trie.size > limit:
                    yield from _rows(trie.terminals(), keep_text)
                    trie = Trie()
        yield from _rows(trie.terminals(), keep_text)
    return run


def _heavy(texts: DataFrame, limit: int) -> list[tuple[int, list[int]]]:
    """(prefix length, hashes of the prefixes that more than ``limit`` bytes of
    different texts begin with), at most (all bytes / limit) each."""
    out, length = [], FIRST_PREFIX
    while True:
        prefix = F.substring("text", 1, length)
        sizes = (texts.groupBy(prefix.alias("prefix"), "h").agg(F.max(F.octet_length("text")).alias("n"))
                 .groupBy("prefix").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")))
        found = [r[0] for r in sizes.where((F.col("n") > limit) & (F.col("texts") > 1)).select(F.xxhash64("prefix")).collect()]
        if not found:
            return out
        out.append((length, found))
        texts = texts.where(F.xxhash64(prefix).isin(found))
        length *= 4


def _prefix(heavy: list[tuple[int, list[int]]]) -> Column:
    """The shortest prefix of a text that is not heavy."""
    last = FIRST_PREFIX * 4 ** len(heavy)
    out = F.substring("text", 1, last)
    for length, found in reversed(heavy):
        prefix = F.substring("text", 1, length)
        out = F.when(~F.xxhash64(prefix).isin(found), prefix).otherwise(out)
    return out


def first_holders(docs: DataFrame, id_col="doc_id", text_col="text", local_bytes=LOCAL_BYTES,
                  range_bytes=RANGE_BYTES, least_heavy=LEAST_HEAVY) -> DataFrame:
    """(id, h): for each distinct text the smallest id and the text's hash."""
    spark = docs.sparkSession
    batch_rows(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
    local = cut(rows.mapInArrow(_inserted(local_bytes, True), "id long, h long, text binary"), "tries")
    total = local.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ranges = max(spark.sparkContext.defaultParallelism, math.ceil(total / range_bytes))
    heavy = _heavy(local.select("h", "text"), max(least_heavy, total // (2 * ranges)))
    ranged = local.withColumn("prefix", _prefix(heavy)).repartitionByRange(ranges, "prefix").select("id", "h", "text")
    return ranged.mapInArrow(_inserted(None, False), "id long, h long")


@F.arrow_udf(IntegerType())
def text_mask(text: pa.Array) -> pa.Array:
    """Bits of the filters A to D, from the lowest."""
    out = [np.zeros(0, np.int32)]
    for i, j, data, offs in T.text_slices(text):
        def total(flags, offs=offs):
            return np.diff(np.concatenate([[0], np.cumsum(flags)])[offs])

        s, e, first = T.words(data, offs)
        n = np.diff(first)
        bits = np.uint64((j - i).bit_length())
        key = np.sort((T.rows_of(n).astype(np.uint64) << (np.uint64(64) - bits)) | (T.hash_spans(data, s, e) >> bits))
        new = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
        distinct = T.spread(new, n)
        capitals = total((data >= 65) & (data <= 90))
        out.append((n < MIN_WORDS) + 2 * (100 * distinct < MIN_DISTINCT * n)
                   + 4 * (100 * capitals > MAX_CAPITALS * total(T.code_points(data))) + 8 * (total(_IS_SYMBOL[data]) > 0))
    return pa.array(np.concatenate(out), pa.int32())


text_mask = text_mask.asNondeterministic()


def masks(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", part_col="source", **sizes) -> DataFrame:
    """(doc_id, part, mask, n, good, toxic): ``n`` equal rows fail the filters
    of ``mask`` (bit 0: A) and carry those labels.  No text is moved here."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_mask(text).alias("bits"))
    slim = slim.groupBy("doc_id", "h", "part", "bits").agg(F.count(F.lit(1)).alias("n"))
    first = first_holders(docs, id_col, text_col, **sizes).select(F.col("id").alias("doc_id"), "h", F.lit(True).alias("first"))
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(*[F.max((F.col(c) == 1).cast("int")).alias(k) for k, c in (("good", "quality"), ("toxic", "toxic"))]))
    copied = F.when(F.col("doc_id").isNull() | F.col("first"), 0).otherwise(16)
    return (slim.join(first, ["doc_id", "h"], "left").join(marks, "doc_id", "left")
            .select("doc_id", "part", (F.col("bits") + copied).alias("mask"), "n",
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def audit(masked: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step (1 to 5)."""
    cells = masked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    each = cells.withColumn("filter_order", F.explode(F.split(F.lit(",".join(ORDERS)), ",")))
    # The step at which a document of this mask is removed; 6: it stays.
    met = [F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.instr(F.col("filter_order"), f)).otherwise(6)
           for k, f in enumerate(FILTERS)]
    each = each.withColumn("gone", F.least(*met)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = F.instr(F.lit(FILTERS), F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))
    bit = F.call_function("shiftleft", F.lit(1), place - 1)
    each = each.withColumn("bit", bit).withColumn("fails", F.col("mask").bitwiseAND(F.col("bit")) != 0)
    here, n = F.col("gone") == F.col("step"), F.col("n")

    def count(test, what=n):
        return F.sum(F.when(test, what).otherwise(0)).cast("long")

    # A filter is the first of a mask's m filters in 1 / m of all orders.
    share = n * F.expr(f"{len(ORDERS)} div bit_count(mask)")
    return each.groupBy("part", "filter_order", "step").agg(
        count(F.col("gone") > F.col("step")).alias("kept"), count(here).alias("removed"),
        count(F.col("fails") & (F.col("gone") < F.col("step"))).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(here, F.col("good")).alias("good_lost"), count(here, F.col("toxic")).alias("toxic_lost"),
        count(F.col("fails"), share).alias("shapley"))
