"""Look-back / horizon window joins (J1-J5) and the weekly resample.

Physical plan (SURVEY section 4.1, "plan D", made skew-proof):

* Every sample is (basin, issue date) and needs the rows of its basin with
  ``issue + lo <= date <= issue + hi``.
* Issue dates are grouped into *time blocks* of ``block_days``.  A series row
  is copied to each block whose issue dates can use it (at most
  ``ceil((hi - lo) / block_days) + 1`` copies, 2 with the defaults), and the
  copies are hash-partitioned by ``(basin, block)``.  That is the only
  shuffle of source rows.  A basin with a long or dense record is spread over
  many blocks, so no basin lands in a single task.
* Each row generates its issue dates: by arithmetic from a fixed stride, or
  from the candidates of its (basin, block) when these are given.  Candidates
  are brought to the same (basin, block) partitioning as one short array a
  key, so a basin or date that is no candidate is never fanned out, and there
  is no join with a calendar.
* The fan-out keeps the partitioning, so every later window and aggregate
  keyed by (basin, block, issue, ...) runs without another exchange.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .calendar import Blocks, calendar_dates, issue_days_between

DEFAULT_BLOCK_DAYS = 320


def block_of(date_col, block_days: int = DEFAULT_BLOCK_DAYS) -> Column:
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.floor(F.unix_date(c) / F.lit(block_days)).cast("int")


def candidate_days(candidates: DataFrame, key: str, block_days: int = DEFAULT_BLOCK_DAYS,
                   issue: str = "issue_date") -> DataFrame:
    """(key, block, days): the candidate issue dates of each time block, as
    ``array<struct<split, sday>>`` (at most ``block_days`` of them)."""
    day = F.struct(F.col("split"), F.unix_date(issue).alias("sday"))
    return candidates.groupBy(key, block_of(issue, block_days).alias("block")).agg(F.collect_set(day).alias("_days"))


def combine_copies(series: DataFrame, key: str, values: list[str],
                   date_col: str = "date", extra_keys: tuple[str, ...] = ("src",)) -> DataFrame:
    """Pre-aggregate copies of a (key, date) cell *before* the fan-out shuffle.

    A group of copies may hold a large share of all rows; grouping first lets
    Spark combine them map-side (partial aggregation), so no copy group
    reaches one task whole.  Output per cell: ``n`` (rows, for length gates
    that must see every copy), ``s{i}`` (sum of non-missing values) and
    ``c{i}`` (their count), from which every mean is ``sum / count``.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, v in enumerate(values):
        aggs += [F.sum(v).alias(f"s{i}"), F.count(v).alias(f"c{i}")]
    return series.groupBy(key, date_col, *extra_keys).agg(*aggs)


def cell_mean(i: int, cond: Column | None = None) -> Column:
    """Mean of value ``i`` over combined cells (NULL when nothing is there)."""
    s, c = F.col(f"s{i}"), F.col(f"c{i}")
    if cond is not None:
        s, c = F.when(cond, s), F.when(cond, c)
    return F.try_divide(F.sum(s), F.sum(c))


def fan_partitions(spark: SparkSession, n: int | None = None) -> int:
    """Partition count of the (basin, block) exchange.

    Given explicitly: the rows multiply ~50x *after* this exchange, so sizes
    measured at the exchange (what AQE would coalesce on) say nothing about
    the work behind it, and a by-number repartition is left alone by AQE.
    Default: ``basinflow.partitions`` if set, else 3x the cluster's default
    parallelism (total executor cores), so every core gets work and a slow
    partition does not hold the stage.
    """
    if n:
        return int(n)
    conf = spark.conf.get("basinflow.partitions", None)
    if conf:
        return int(conf)
    return 3 * int(spark.sparkContext.defaultParallelism)


def fan_out(series: DataFrame, key: str, blocks: Blocks, stride, lo: int, hi: int,
            block_days: int = DEFAULT_BLOCK_DAYS, date_col: str = "date",
            partitions: int | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """Rows of ``series`` attached to every sample window containing them.

    Returns the series columns plus ``block, split, issue_date, sday, off``
    where ``off = date - issue_date`` lies in ``[lo, hi]``.  With ``candidates``
    (``key``, split, issue_date) only their samples are built.  A series stored
    by (key, block) (``sinks.blocked``) is not moved.
    """
    stored = None if isinstance(series, DataFrame) else series
    if stored is not None:
        stored.check(key, lo, hi, block_days)
        series, partitions = stored.df, stored.buckets
    spark = series.sparkSession
    cal = calendar_dates(blocks, stride)
    if not cal:
        raise ValueError("empty issue calendar")
    first = min(d for _, d in cal)
    last = max(d for _, d in cal)
    n = fan_partitions(spark, partitions)
    # Only rows some window can use reach the shuffle (pushed to the scan).
    s = series.where(F.col(date_col).between(F.lit(first + dt.timedelta(days=lo)),
                                             F.lit(last + dt.timedelta(days=hi))))
    b_min = F.lit((first - dt.date(1970, 1, 1)).days // block_days)
    b_max = F.lit((last - dt.date(1970, 1, 1)).days // block_days)
    if stored is not None:
        s = s.where(F.col("block").between(b_min, b_max))
    else:
        b_lo = F.greatest(block_of(F.date_sub(F.col(date_col), hi), block_days), b_min)
        b_hi = F.least(block_of(F.date_sub(F.col(date_col), lo), block_days), b_max)
        s = s.withColumn("block", F.explode(F.sequence(b_lo, b_hi)))
        if candidates is not None:
            s = s.join(candidates.select(key).distinct(), key, "left_semi")
        s = s.repartition(n, key, "block")
    day = F.unix_date(date_col)
    if candidates is not None:
        days = candidate_days(candidates, key, block_days).repartition(n, key, "block")
        s = s.join(days.hint("shuffle_hash"), [key, "block"])
        mine = F.filter("_days", lambda d: (d["sday"] >= day - hi) & (d["sday"] <= day - lo))
    else:
        block_first = F.col("block") * block_days
        mine = issue_days_between(F.greatest(day - hi, block_first),
                                  F.least(day - lo, block_first + (block_days - 1)), blocks, stride)
    out = s.withColumn("_d", F.explode(mine))
    return out.select(*[c for c in s.columns if c != "_days"], F.col("_d.split").alias("split"),
                      F.date_from_unix_date("_d.sday").alias("issue_date"), F.col("_d.sday").alias("sday"),
                      (day - F.col("_d.sday")).alias("off"))


def weekly_bins(fan: DataFrame, part: list[str], in_week: Column, days: int = 7,
                extra: dict[str, Column] | None = None) -> DataFrame:
    """7-day bins anchored at the first row present in the weekly slice.

    Adds ``anchor`` (first present date), ``n_bins`` (``max(bin)+1``, so an
    empty inner bin still counts) and ``bin`` (NULL outside the slice).
    ``extra`` aggregates over the same partition ride in the same Window
    operator (one sort, one pass).
    """
    w = Window.partitionBy(*part)
    wk_date = F.when(in_week, F.col("date"))
    more = [agg.over(w).alias(name) for name, agg in (extra or {}).items()]
    fan = fan.select("*", F.min(wk_date).over(w).alias("anchor"),
                     F.max(wk_date).over(w).alias("_wk_last"), *more)
    return (fan.withColumn("n_bins", F.coalesce(
                F.floor(F.datediff("_wk_last", "anchor") / days) + 1, F.lit(0)).cast("int"))
            .withColumn("bin", F.when(in_week, F.floor(
                F.datediff("date", "anchor") / days).cast("int")))
            .drop("_wk_last"))
