"""Distributed row numbering, batches and resume bookkeeping.

``global_row_number`` numbers rows 1..n in a total order without funnelling
them through one task: rows are range-partitioned on the order keys (Spark
samples the keys, so a heavily repeated leading value is split by the
following keys), numbered inside each partition, and shifted by the row
counts of the partitions before them.  The count table has one row per
partition -- its size is the partition count, a configuration value -- so it
is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import batch_file_name
from ..session import checkpoint_dir


MAX_OFFSET_ROWS = 200_000


def _order_cols(order):
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _ranged(df: DataFrame, cols: list[Column], partitions: int | None) -> DataFrame:
    """Rows range-partitioned and sorted, with partition and place numbers.

    Written once: the partitions and their row order are then fixed, even if
    an executor is lost later, so a row's place in its partition is simply the
    low bits of monotonically_increasing_id (no second shuffle, no window)."""
    from .windows import fan_partitions
    spark = df.sparkSession
    checkpoint_dir(spark)
    return (df.repartitionByRange(fan_partitions(spark, partitions), *cols).sortWithinPartitions(*cols)
            .checkpoint(eager=True)
            .withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright("_mid", 33))
            .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("_mid"))


def _with_offsets(ranked: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    """Join the offsets, broadcast where their checked number is small."""
    small = offsets.limit(MAX_OFFSET_ROWS + 1).count() <= MAX_OFFSET_ROWS
    return ranked.join(F.broadcast(offsets) if small else offsets, keys)


def global_row_number(df: DataFrame, order: list, out: str = "rn",
                      partitions: int | None = None, total: str | None = None) -> DataFrame:
    """``out`` = 1-based position of each row in ``order`` (keys must be unique).

    ``total`` optionally names a column holding the overall row count.
    """
    ranked = _ranged(df, _order_cols(order), partitions)
    counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w_off), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    return (_with_offsets(ranked, offsets, ["_pid"])
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
            .withColumnRenamed("_total", total or "_total")
            .drop("_pid", "_local", "_off", *([] if total else ["_total"])))


def assign_batches(samples: DataFrame, size: int, order: list[str],
                   within: list[str] | None = None, out: str = "batch_id") -> DataFrame:
    """Samples in ``order``, ``size`` per batch, the last batch short.

    Numbering restarts in every ``within`` group (e.g. per split).  Ordered by
    group first, a group's rows are contiguous in each partition, so counts per
    (partition, group) give the start of each run; there are at most partitions
    + groups of them, and the samples themselves move once.
    """
    within = within or []
    ranked = _ranged(samples, _order_cols(within + order), None)
    runs = ranked.groupBy("_pid", *within).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_local").alias("_first"))
    before = Window.partitionBy(*within).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("_pid", *within, (F.coalesce(F.sum("_cnt").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    keyed = _with_offsets(ranked, offsets, ["_pid", *within])
    return (keyed.withColumn("pos", (F.col("_local") + F.col("_off")).cast("long"))
            .withColumn(out, F.floor(F.col("pos") / size).cast("int"))
            .withColumn("pos_in_batch", (F.col("pos") % size).cast("int"))
            .drop("_pid", "_local", "_off"))


def shuffle_key(keys: list[str], seed: int) -> Column:
    """A per-epoch random but reproducible order: MD5 of the keys and the
    seed (a standard digest, so any engine can reproduce the order)."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


# A prime modulus and the step of the generator of round keys.
_PRIME = 2147483647
_STEP = 48271


def round_keys(seed: int, rounds: int) -> list[tuple[int, int, int]]:
    """(shift, factor, offset) of each round, by a multiplicative generator."""
    x, out = (seed * 7919 + 12345) % (_PRIME - 1) + 1, []
    for _ in range(rounds):
        key = []
        for _ in range(3):
            x = x * _STEP % _PRIME
            key.append(x)
        out.append(tuple(key))
    return out


def epoch_position(pos: Column, total: Column, seed: int, rounds: int = 24) -> Column:
    """W6 without a sort: a keyed permutation of the places 0 .. ``total`` - 1.

    Swap or not: in each round a place and its mirror about the round's shift
    (both smaller than ``total``, whatever it is) change places or stay, by one
    bit that the pair shares; so every round, and all together, map places to
    places one to one.  An epoch's order is a projection of numbered samples."""
    def swap(x, key):
        mirror = F.pmod(key["shift"] - x, total)
        pair = F.greatest(x, mirror)
        bit = F.pmod(F.pmod(F.pmod(pair, F.lit(_PRIME)) * key["factor"] + key["offset"], F.lit(_PRIME)), F.lit(2))
        return F.when(bit == 1, mirror).otherwise(x)

    keys = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(k, ("shift", "factor", "offset"), strict=True)])
                     for k in round_keys(seed, rounds)])
    return F.aggregate(keys, pos.cast("long"), swap)


def epoch_batches(numbered: DataFrame, size: int, seed: int, within: str = "split", pos: str = "pos") -> DataFrame:
    """Batches of one epoch from samples numbered once (``pos`` from 0 in
    each ``within`` group): only the groups' sizes are counted and broadcast,
    one row a group; no sample is moved or sorted."""
    totals = numbered.groupBy(within).agg(F.count(F.lit(1)).alias("_total"))
    at = epoch_position(F.col(pos), F.col("_total"), seed)
    return (numbered.drop("batch_id", "pos_in_batch").join(F.broadcast(totals), within).withColumn("epoch_pos", at)
            .withColumn("batch_id", F.floor(F.col("epoch_pos") / size).cast("int"))
            .withColumn("pos_in_batch", (F.col("epoch_pos") % size).cast("int")).drop("_total"))


def batch_names(batched: DataFrame, split_col: str = "split", batch_col: str = "batch_id") -> DataFrame:
    """file label of each batch."""
    return batched.withColumn("file_name", batch_file_name(split_col, batch_col))


def resume_candidates(candidates: DataFrame, done: DataFrame,
                      keys: tuple[str, ...] = ("split", "basin_id", "issue_date")) -> DataFrame:
    """Candidates not yet written by an earlier run (anti-join on keys)."""
    return candidates.join(done.select(*keys).distinct(), list(keys), "left_anti")


def resume_state(batched: DataFrame, splits: list[str], split_col: str = "split",
                 batch_col: str = "batch_id", pos_col: str = "pos") -> DataFrame:
    """Per split the last written key and the next batch number.

    ``next_batch`` is ``max(batch)+1``, 0 for a split with nothing written.
    """
    spark = batched.sparkSession
    last = batched.groupBy(split_col).agg(
        F.max(batch_col).alias("_mb"),
        F.max_by(F.struct("basin_id", "forecast_date"), F.col(pos_col)).alias("_last"))
    all_splits = spark.createDataFrame([(s,) for s in splits], f"{split_col} string")
    return (all_splits.join(last, split_col, "left")
            .select(split_col,
                    F.col("_last.basin_id").alias("last_basin"),
                    F.col("_last.forecast_date").alias("last_date"),
                    F.coalesce(F.col("_mb") + 1, F.lit(0)).alias("next_batch")))
