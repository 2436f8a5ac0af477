"""Hashed questions from chunks of documents to buckets, and answers back.

Some corpus-wide facts about a hash (is it in several documents, how often,
who has it first) are needed again beside the text.  Documents are dealt into
chunks of bounded size; a chunk asks each distinct hash once, packed into one
array per bucket of the hash space; a bucket's task answers every array in its
own order; the answers meet the chunk's documents again in a cogroup.

A hash that a third of all rows hold is asked once a chunk, so no bucket
grows with it, and what is sent is a few bytes a distinct hash of a chunk.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from basinflow.llm import textops as T
from basinflow.llm.store import batch_rows

CHUNK_BYTES = 8 << 20       # text of a chunk, on average
BUCKET_BYTES = 16 << 20     # text that a bucket answers for, on average
ROWS = "chunk int, bucket int, blob binary"
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Chunked:
    """``docs`` (chunk, doc_id, text), dealt by chunk; equal rows share one."""
    docs: DataFrame
    chunks: int
    buckets: int

    def ask(self, questions) -> DataFrame:
        """``questions(Batch)`` yields (bucket, bytes) of one chunk."""
        def send(table: pa.Table) -> pa.Table:
            batch = Batch(table)
            got = list(questions(batch))
            return _rows(batch.chunk, got)
        return self.docs.groupBy("chunk").applyInArrow(send, ROWS)

    def with_answers(self, answers: DataFrame, use, schema: str) -> DataFrame:
        """``use(Batch, {bucket: bytes})`` returns a table for one chunk."""
        def meet(table: pa.Table, replies: pa.Table) -> pa.Table:
            replies = dict(zip(replies.column("bucket").to_pylist(), replies.column("blob").to_pylist(), strict=True))
            return use(Batch(table), replies)
        return self.docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(meet, schema)


class Batch:
    """The documents of one chunk, in the order of their ids and texts."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        if pa.types.is_binary(table.schema.field("text").type):
            table = table.set_column(table.schema.get_field_index("text"), "text", _unpacked(table.column("text")))
        self.chunk = table.column("chunk")[0].as_py() if len(table) else -1
        self.ids = table.column("doc_id")
        self.id = self.ids.fill_null(NO_ID).to_numpy().astype(np.int64)
        self.data, self.offs = T.text_buffers(table.column("text"))


@F.arrow_udf(BinaryType())
def _packed(text: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd", compression_level=3)
    out = []
    for x in text.cast(pa.large_binary()).to_pylist():
        out.append(None if x is None else len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True))
    return pa.array(out, pa.binary())


def _unpacked(col: pa.ChunkedArray) -> pa.ChunkedArray:
    codec = pa.Codec("zstd")
    rows = [None if x is None else codec.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True) for x in col.to_pylist()]
    return pa.chunked_array([pa.array(rows, pa.large_binary()).cast(pa.large_string())])


def chunked(docs: DataFrame, id_col="doc_id", text_col="text", chunk_bytes=CHUNK_BYTES,
            bucket_bytes=BUCKET_BYTES, packed: bool = False) -> Chunked:
    """Deal ``docs`` by a hash of id and text.  The numbers of chunks and
    buckets follow the corpus, so that neither grows in size.  ``packed`` texts
    are compressed before they are moved."""
    batch_rows(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    dealt = docs.select(F.pmod(F.xxhash64(id_col, F.xxhash64(text_col)), F.lit(chunks)).cast("int").alias("chunk"),
                        F.col(id_col).cast("long").alias("doc_id"), (_packed(F.col(text_col)) if packed else F.col(text_col)).alias("text"))
    return Chunked(dealt.repartition(chunks, "chunk"), chunks, max(1, math.ceil(total / bucket_bytes)))


def _rows(chunk: int, got: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"chunk": pa.array([chunk] * len(got), pa.int32()),
                     "bucket": pa.array([b for b, _ in got], pa.int32()),
                     "blob": pa.array([x for _, x in got], pa.binary())})


def answer(asked: DataFrame, reply) -> DataFrame:
    """``reply(list of bytes) -> list of bytes`` for each bucket; rows of a
    negative bucket are a chunk's own notes and pass through."""
    def respond(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table
        return table.set_column(2, "blob", pa.array(reply(table.column("blob").to_pylist()), pa.binary()))
    return asked.groupBy("bucket").applyInArrow(respond, ROWS)


def note(chunk: int) -> int:
    """The bucket number of a chunk's notes to itself."""
    return -1 - chunk


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit hash, from its upper half."""
    return (h >> np.uint64(32)) % np.uint64(buckets)


def by_bucket(bucket: np.ndarray):
    """(bucket, first, last) of each run of a sorted array."""
    cut = np.flatnonzero(np.diff(bucket)) + 1
    for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)], strict=True):
        if j > i:
            yield int(bucket[i]), i, j
