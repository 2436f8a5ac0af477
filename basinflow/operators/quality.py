"""Quality gates and reports.

Reports are grouped aggregates: their output is one row per group (gauge,
split, reason, length), so they partial-aggregate before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import group_file_name, is_missing


def coverage(flow: DataFrame, min_end, key: str = "gauge_id", value: str = "streamflow_cms",
             date: str = "date") -> DataFrame:
    """Per gauge, rows left after dropping missing values and last date.

    ``usable`` = non-empty and last date >= ``min_end``; ``reason`` says why not.
    """
    ok = flow.where(~is_missing(value))
    g = ok.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.max(date).alias("last_date"))
    return g.select(
        key, "n_rows", "last_date",
        F.when(F.col("last_date") < F.lit(min_end).cast("date"), F.lit("stale"))
        .alias("reason"))


def usable_gauges(gauges: DataFrame, flow: DataFrame, min_end, key: str = "gauge_id") -> DataFrame:
    """J9 + A7: gauges with a covering, non-empty record (semi-join)."""
    good = coverage(flow, min_end, key).where(F.col("reason").isNull()).select(key)
    return gauges.join(good, key, "left_semi")


def skipped_gauges(gauges: DataFrame, flow: DataFrame, min_end, key: str = "gauge_id") -> DataFrame:
    """Gauges without usable flow, with the reason (anti-join + left join)."""
    cov = coverage(flow, min_end, key)
    bad = gauges.join(cov.where(F.col("reason").isNull()).select(key), key, "left_anti")
    return (bad.join(cov.select(key, "reason", "last_date"), key, "left")
            .withColumn("reason", F.coalesce(F.col("reason"), F.lit("no_data"))))


def length_histogram(stats: DataFrame, expected: int) -> DataFrame:
    """Samples per (split, target length, weather length) and whether
    that length is the declared one."""
    return (stats.groupBy("split", "len_target", "len_weather")
            .agg(F.count(F.lit(1)).alias("n_samples"))
            .withColumn("expected", (F.col("len_target") == expected)
                        & (F.col("len_weather") == expected)))


def require_valid(stats: DataFrame, expected: int) -> DataFrame:
    """A3: ``stats`` again, or an error when no sample has the declared length."""
    ok = (F.col("len_target") == expected) & (F.col("len_weather") == expected)
    if not stats.where(ok).limit(1).count():
        raise ValueError(f"no valid sample: none has length {expected}")
    return stats


def null_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column the number of missing cells and whether any is missing."""
    aggs = [F.sum(is_missing(c).cast("long")).alias(c) for c in cols]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n_missing)")
            .withColumn("n_missing", F.coalesce(F.col("n_missing"), F.lit(0)).cast("long"))
            .withColumn("any_missing", F.col("n_missing") > 0))


def drop_report(candidates: DataFrame, stats: DataFrame) -> DataFrame:
    """Candidates per (split, outcome).

    ``stats`` holds one row per candidate sample that has any data, so the
    ``no_data`` candidates are the difference of two counts per split: no join
    of candidates and samples."""
    outcome = F.coalesce(F.col("reason"), F.lit("accepted")).alias("outcome")
    seen = stats.groupBy("split", outcome).agg(F.count(F.lit(1)).alias("n"))
    marks = (candidates.select("basin_id", "split", "issue_date").distinct()
             .groupBy("split").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit("no_data")))
    both = seen.withColumn("total", F.lit(0).cast("long")).unionByName(
        marks.withColumn("total", F.col("n")).withColumn("n", F.lit(0).cast("long")))
    per_split = Window.partitionBy("split")
    both = both.withColumn("n", F.when(F.col("outcome") == "no_data", F.sum("total").over(per_split)
                                       - F.sum("n").over(per_split)).otherwise(F.col("n")))
    return both.where("n > 0").select("split", "outcome", F.col("n").alias("n_samples"))


def run_summary(samples: DataFrame, key: str = "basin_id", split: str = "split",
                sample_key: str = "forecast_date") -> DataFrame:
    """Samples per (gauge, split) and the group's file label."""
    return (samples.groupBy(key, split)
            .agg(F.countDistinct(sample_key).alias("n_samples"))
            .withColumn("filename", group_file_name(split, key, F.col("n_samples"))))
