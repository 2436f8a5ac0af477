"""Sinks (K1-K6, A16 output): partitioned, restartable writes.

No sink funnels data through one task: batches and re-layout are range-partitioned
and sorted, per-group output comes from ``partitionBy``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import FLAG_LEGEND



def _with_legend(df: DataFrame, col: str = "dynamic_inputs",
                 features: list[str] | None = None) -> DataFrame:
    """feature names and the flag legend as column metadata."""
    if col not in df.columns:
        return df
    meta = {"flag_description": json.dumps(FLAG_LEGEND)}
    if features:
        meta["feature"] = features
    return df.withMetadata(col, meta)


def write_batches(df: DataFrame, path: str, mode: str = "overwrite",
                  features: list[str] | None = None, partitions: int | None = None) -> None:
    """K1: numbered batches (``batch_id``, ``file_name`` from ``assign_batches``).

    Rows are range-partitioned by (split, batch, place), so a batch lies in one
    or two files, many batches share a file of ordinary size, and row-group
    statistics on ``batch_id`` find a batch again."""
    from ..operators.windows import fan_partitions
    n = fan_partitions(df.sparkSession, partitions)
    order = ["split", "batch_id", "pos"]
    (_with_legend(df, features=features).repartitionByRange(n, *order).sortWithinPartitions(*order)
     .write.mode(mode).partitionBy("split").parquet(path))


def write_partitioned(df: DataFrame, path: str, keys=("split", "basin_id"),
                      mode: str = "overwrite") -> None:
    """K2: one output folder per (split, gauge); overwrite replaces old scratch.

    Dynamic partition overwrite, a writer option, only replaces the groups
    being written.
    """
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def drop_groups(groups: DataFrame, path: str, keys=("split", "basin_id")) -> int:
    """Remove the folders of ``groups`` (their key columns) from a partitioned
    output: groups that have no rows any more.  Safe to repeat."""
    from .tables import delete_folder
    spark, gone = groups.sparkSession, 0
    for row in groups.select(*keys).distinct().toLocalIterator():
        gone += delete_folder(spark, "/".join([path.rstrip("/"), *[f"{k}={row[k]}" for k in keys]]))
    return gone


def write_splits(df: DataFrame, path: str, features: list[str] | None = None) -> None:
    """K3: the combined sample set, one folder per split (no single-file write).

    Rebalanced by split: AQE sizes the files and cuts a large split."""
    (_with_legend(df, features=features).hint("rebalance", "split")
     .write.mode("overwrite").partitionBy("split").parquet(path))


def write_summary(summary: DataFrame, path: str) -> None:
    """K4: run summary as CSV with header."""
    summary.write.mode("overwrite").option("header", True).csv(path)


def write_flow_cache(flow: DataFrame, skipped: DataFrame, flow_path: str, skipped_path: str) -> None:
    """K5: cached streamflow table and skipped-gauge list."""
    flow.write.mode("overwrite").parquet(flow_path)
    skipped.select(F.col("gauge_id").cast("string").alias("value")).write.mode("overwrite").text(skipped_path)


def relayout(df: DataFrame, path: str, key: str = "basin_id", order: str = "date",
             partitions: int | None = None) -> None:
    """K6: rewrite a grid so each basin's dates are contiguous and sorted.

    Range-partitioned by (basin, date), so a long record spans several tasks;
    Parquet row-group min/max statistics then prune basin and date reads.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, key, order).sortWithinPartitions(key, order).write.mode("overwrite").parquet(path)
