"""Best-fit packing of token pieces into sequences, by residual vectors.

A sequence has three capacities: tokens, documents and attention cost (the
sum of squared piece lengths).  Pieces are taken longest first; each goes to
the open sequence that can hold it under every capacity and leaves the least
weighted residual norm (``rule='norm'``), or has the largest weighted dot
product of demand and residual (``rule='dot'``); if none can, it opens one.

Pieces are dealt evenly into groups of bounded size, each packed on its own;
sequences that stay too empty are dissolved and their pieces packed again
across groups, so what a group leaves open does not add up.

Defined results: a null text is an empty one, its only id is the end id; only
documents over the token capacity are cut, from their end, so the first piece
takes the rest.  Repeated rows are packed as often as they occur.  An empty
table gives no row.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from basinflow.llm import textops as T
from basinflow.llm.bpe_ids import encoder
from basinflow.llm.store import batch_rows, cut

END_ID = 2
MAX_TOKENS = 1024
GROUP_PIECES = 8192     # pieces of one packing group, on average
GOOD_FILL = 0.97        # sequences below this are dissolved once

_PIECES = ArrayType(StructType([
    StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()),
    StructField("ids_crc32", LongType()), StructField("ids", ArrayType(IntegerType()))]))


def _pieces_udf(path: str, max_tokens: int, end_id: int, keep_ids: bool):
    def pieces(text: pa.Array) -> pa.Array:
        enc = encoder(path)
        rows, per_doc, ids_kept = [], [], []
        for _, _, data, offs in T.text_slices(text):
            ids, n = enc.encode(data, offs)
            ends = np.cumsum(n)
            ids = np.insert(ids, ends, end_id).astype("<u4")
            n = n + 1
            begin = np.cumsum(n) - n
            for b, m in zip(begin.tolist(), n.tolist(), strict=True):
                k = -(-m // max_tokens)
                cuts = [0, *range(m - (k - 1) * max_tokens, m + 1, max_tokens)]
                per_doc.append(k)
                for p, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = ids[b + x:b + y]
                    rows.append((p, x, y - x, zlib.crc32(part)))
                    if keep_ids:
                        ids_kept.append(part.astype(np.int32))
        cols = np.array(rows, np.int64).reshape(-1, 4)
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(cols[:, k], t) for k, t in enumerate(kinds)]
        if keep_ids:
            lengths = pa.array(np.concatenate([[0], np.cumsum(cols[:, 2])]), pa.int32())
            arrays.append(pa.ListArray.from_arrays(lengths, pa.array(np.concatenate([np.zeros(0, np.int32), *ids_kept]))))
        else:
            arrays.append(pa.nulls(len(cols), pa.list_(pa.int32())))
        items = pa.StructArray.from_arrays(arrays, ["piece", "start", "length", "ids_crc32", "ids"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()), items)
    return F.arrow_udf(pieces, _PIECES).asNondeterministic()


def token_pieces(docs: DataFrame, path: str, id_col="doc_id", text_col="text", max_tokens=MAX_TOKENS,
                 end_id=END_ID, keep_ids=False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ids)."""
    batch_rows(docs.sparkSession)
    got = docs.select(F.col(id_col).alias("doc_id"),
                      _pieces_udf(path, max_tokens, end_id, keep_ids)(F.col(text_col)).alias("p"))
    out = got.select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.*")
    return out if keep_ids else out.drop("ids")


def best_fit(length: np.ndarray, capacity, weights=(1.0, 0.0, 0.0), rule="norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece of one group."""
    cap = np.asarray(capacity, np.float64)
    w = np.asarray(weights, np.float64)
    order = np.argsort(-length, kind="stable")
    least = int(length.min()) if len(length) else 0
    seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    size = 64
    left, name, n, made = np.zeros((3, size)), np.zeros(size, np.int64), 0, 0
    for i in order.tolist():
        need = np.array([length[i], 1.0, float(length[i]) ** 2])
        ok = np.flatnonzero((left[0, :n] >= need[0]) & (left[1, :n] >= 1) & (left[2, :n] >= need[2]))
        if len(ok):
            open_ = left[:, ok]
            if rule == "norm":
                worth = -(w[:, None] * ((open_ - need[:, None]) / cap[:, None]) ** 2).sum(0)
            else:
                worth = (w[:, None] * (open_ / cap[:, None]) * (need / cap)[:, None]).sum(0)
            k = int(ok[np.argmax(worth)])
        else:
            if n == size:
                left, name, size = np.concatenate([left, np.zeros_like(left)], 1), np.concatenate([name, name * 0]), size * 2
            k, n = n, n + 1
            left[:, k], name[k], made = cap, made, made + 1
        seq[i], off[i] = name[k], cap[0] - left[0, k]
        left[:, k] -= need
        if left[0, k] < least or left[1, k] < 1 or left[2, k] < least * least:
            n -= 1                                  # nothing fits any more: close
            left[:, k], name[k] = left[:, n], name[n]
    return seq, off


def _pack_round(items: DataFrame, group_pieces: int, capacity, weights, rule, turn: int, name: str) -> DataFrame:
    """``items`` (rid, length) with seq, offset and fill (tokens in its sequence)."""
    count = items.count()
    groups = max(1, math.ceil(count / group_pieces))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("rid", "ascending")])
        length = table.column("length").to_numpy()
        seq, off = best_fit(length, capacity, weights, rule)
        fill = np.bincount(seq, length).astype(np.int64)[seq] if len(seq) else seq
        grp = table.column("grp").to_numpy().astype(np.int64)
        return pa.table({"rid": table.column("rid"), "seq": (turn << 60) + (grp << 24) + seq, "off": off, "fill": fill})

    dealt = items.select("rid", "length", F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(groups)).cast("int").alias("grp"))
    return cut(dealt.groupBy("grp").applyInArrow(pack, "rid long, seq long, off long, fill long"), name)


def pack(pieces: DataFrame, max_tokens=MAX_TOKENS, max_docs: int | None = None, max_cost: float | None = None,
         weights=(1.0, 0.0, 0.0), rule="norm", group_pieces=GROUP_PIECES) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id`` and ``offset``.

    ``max_docs`` and ``max_cost`` default to values that never bind.  A piece
    that alone exceeds the attention capacity is an error of the caller."""
    capacity = (max_tokens, max_docs or max_tokens, max_cost or float(max_tokens) ** 2)
    if capacity[2] < max_tokens ** 2 and pieces.where(F.col("length") * F.col("length") > capacity[2]).limit(1).count():
        raise ValueError("a piece exceeds the attention capacity of a sequence")
    items = cut(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    part = items.where(F.col("length") < max_tokens).select("rid", "length")
    first = _pack_round(part, group_pieces, capacity, weights, rule, 0, "packed")
    poor = F.col("fill") < GOOD_FILL * max_tokens
    left = first.where(poor).join(part, "rid").select("rid", "length")
    again = _pack_round(left, group_pieces, capacity, weights, rule, 1, "repacked")
    placed = first.where(~poor).unionByName(again).select("rid", F.col("seq").alias("sequence_id"), F.col("off").alias("offset"))
    full = items.where(F.col("length") >= max_tokens).withColumns(
        {"sequence_id": -1 - F.col("rid"), "offset": F.lit(0).cast("long")})
    return full.unionByName(items.where(F.col("length") < max_tokens).join(placed, "rid")).drop("rid")
