"""Numbered chunks with a commit log: batch output that a killed run resumes
(K1, A18, A19, J11).

Samples are built and written in chunks of neighbouring gauges.  A chunk's
folder is complete before its entry appears in the log, entries appear in the
order of the chunks, and a reader looks only at logged chunks; so a run that
dies leaves whole batches, and the next run goes on after the last entry.  An
unlogged folder is overwritten.  The log's plan fixes the chunks' bounds, so
later runs cut the gauges alike; it holds one bound a chunk, and an entry one
line a split (and feature), whatever the number of samples.

Batches are numbered per split over all chunks: a chunk starts where the
entries before it end, hence a resumed output equals one full write.  Entries
may carry mergeable moments of their chunk, from which scalers are fitted
without a second look at the samples.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import batch_file_name
from ..operators.ranking import assign_batches
from .tables import delete_folder, path_exists, small_files, write_small
from .writers import write_batches

CHUNKS = 16


@dataclass(frozen=True)
class Chunk:
    """Keys with ``low`` <= key < ``high``; None is open."""
    number: int
    low: str | None
    high: str | None

    def holds(self, key: Column | str, prefix: str = "") -> Column:
        """Predicate on a key column; one comparison a side, so it reaches the
        scan.  ``prefix`` stands before the key in that column."""
        key, test = F.col(key) if isinstance(key, str) else key, F.lit(True)
        if self.low is not None:
            test = test & (key >= prefix + self.low)
        if self.high is not None:
            test = test & (key < prefix + self.high)
        return test


def _folder(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/data/chunk={number}"


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/_log"


def chunk_bounds(keys: DataFrame, key: str, chunks: int) -> list[str]:
    """At most ``chunks`` - 1 lower bounds that cut the rows of ``keys`` (one a
    unit of work) about evenly, between different keys."""
    ranged = keys.where(F.col(key).isNotNull()).select(key).repartitionByRange(chunks, key)
    lows = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("low")).collect()
    return sorted(r["low"] for r in lows)[1:]


def plan(spark: SparkSession, path: str) -> dict | None:
    found = small_files(spark, _log(path), "plan.json")
    return json.loads(found["plan.json"]) if found else None


def entries(spark: SparkSession, path: str) -> list[dict]:
    """The log's entries in the order of the chunks."""
    found = small_files(spark, _log(path), "chunk-")
    return sorted((json.loads(x) for x in found.values()), key=lambda e: e["chunk"])


def chunks_of(plan: dict) -> list[Chunk]:
    cuts = [None, *plan["bounds"], None]
    return [Chunk(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def remaining(spark: SparkSession, path: str, candidates: DataFrame, key: str = "basin_id") -> DataFrame:
    """The candidates of the chunks that no run has written yet; decided
    by the bounds, without reading what was written."""
    fixed = plan(spark, path)
    done = len(entries(spark, path))
    if fixed is None or not done:
        return candidates
    left = chunks_of(fixed)[done:]
    return candidates.where(Chunk(left[0].number, left[0].low, None).holds(key)) if left else candidates.where(F.lit(False))


def write_chunks(spark: SparkSession, path: str, candidates: DataFrame, build: Callable[[Chunk], DataFrame], size: int,
                 order: tuple[str, ...] = ("basin_id", "forecast_date"), within: str = "split", chunks: int = CHUNKS,
                 limit: int | None = None, moments: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Write what is left of the samples of ``candidates``, at most ``limit``
    chunks in this call; returns how many were written.

    ``build(chunk)`` gives the accepted samples of the candidates that
    ``chunk.holds``, one row a sample, with ``order`` and ``within``; ``order``
    starts with the chunks' key.  ``moments(samples)`` gives (``within``,
    feature, n, mean, m2)."""
    key, fixed = order[0], plan(spark, path)
    wanted = {"key": key, "size": size, "order": list(order), "within": within}
    if fixed is None:
        fixed = {**wanted, "bounds": chunk_bounds(candidates, key, chunks)}
        write_small(spark, f"{_log(path)}/plan.json", json.dumps(fixed))
    elif {k: fixed[k] for k in wanted} != wanted:
        raise ValueError(f"{path} was begun with another plan: {fixed}")
    done = entries(spark, path)
    before: dict[str, int] = {}
    for e in done:
        for split, s in e["splits"].items():
            before[split] = before.get(split, 0) + s["n"]
    left = chunks_of(fixed)[len(done):]
    for chunk in left[:limit]:
        entry = _write_chunk(path, chunk, build(chunk), size, list(order), within, before, moments)
        for split, s in entry["splits"].items():
            before[split] = before.get(split, 0) + s["n"]
    return len(left[:limit])


def _write_chunk(path, chunk: Chunk, samples: DataFrame, size, order, within, before, moments) -> dict:
    spark, folder = samples.sparkSession, _folder(path, chunk.number)
    delete_folder(spark, folder)                      # of a run that died here
    rows = assign_batches(samples, size, order, within=[within])
    if before:
        start = F.coalesce(F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[F.col(within)], F.lit(0))
        rows = rows.withColumn("pos", F.col("pos") + start)
        rows = rows.withColumn("batch_id", F.floor(F.col("pos") / size).cast("int")).withColumn(
            "pos_in_batch", (F.col("pos") % size).cast("int"))
    write_batches(rows.withColumn("file_name", batch_file_name(within, "batch_id")), folder)
    written = read_folder(spark, [folder], folder, within)
    if written is None:
        splits = {}
    else:
        last = F.max_by(F.struct(*[F.col(c).cast("string") for c in order]), "pos")
        found = written.groupBy(within).agg(F.count(F.lit(1)).alias("n"), last.alias("last")).collect()      # one row a split
        splits = {r[within]: {"n": r["n"], "last": list(r["last"])} for r in found}
    entry = {"chunk": chunk.number, "splits": splits}
    if moments is not None and written is not None:
        entry["moments"] = [[r[within], r["feature"], r["n"], r["mean"], r["m2"]] for r in moments(written).collect()]   # a split and feature
    write_small(spark, f"{_log(path)}/chunk-{chunk.number:08d}.json", json.dumps(entry))
    return entry


def read_folder(spark: SparkSession, folders: list[str], base: str, within: str) -> DataFrame | None:
    """Parquet folders partitioned by ``within``, read as strings; None where
    no row was written."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.option("basePath", base).schema(_schema(spark, folders, base, within)).parquet(*folders)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _schema(spark, folders, base, within):
    from pyspark.sql import types as T
    found = spark.read.option("basePath", base).parquet(*folders).schema
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name == within else f for f in found])


def read_chunks(spark: SparkSession, path: str, within: str = "split") -> DataFrame | None:
    """Every logged sample, with ``batch_id`` and ``pos``; None if there is none."""
    folders = [_folder(path, e["chunk"]) for e in entries(spark, path) if e["splits"]]
    folders = [x for x in folders if path_exists(spark, x)]
    return read_folder(spark, folders, f"{path.rstrip('/')}/data", within) if folders else None


def chunk_state(spark: SparkSession, path: str, splits: list[str]) -> DataFrame:
    """A18/A19 from the log alone: per split the last written key and the next
    batch number (0 with nothing written)."""
    fixed = plan(spark, path)
    count, last = dict.fromkeys(splits, 0), dict.fromkeys(splits, (None, None))
    for e in entries(spark, path):
        for split, s in e["splits"].items():
            if split in count:
                count[split], last[split] = count[split] + s["n"], s["last"][:2]
    size = fixed["size"] if fixed else 1
    return spark.createDataFrame([(s, *last[s], -(-count[s] // size)) for s in splits],
                                 "split string, last_basin string, last_date string, next_batch int")


def chunk_moments(spark: SparkSession, path: str) -> DataFrame:
    """(split, feature, n, mean, m2) of every logged chunk."""
    rows = [(*m[:2], int(m[2]), *m[3:]) for e in entries(spark, path) for m in e.get("moments", [])]
    return spark.createDataFrame(rows, "split string, feature string, n long, mean double, m2 double")
