"""Tables of one run in the shared checkpoint folder (lineage cuts)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from basinflow.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that a lost
    executor recomputes from files and no step above runs twice."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batch_rows(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of an Arrow batch: texts may be long, so batches are short."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != str(rows):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def aligned_joins(spark: SparkSession) -> None:
    """Let a join on (range, chunk) use what is partitioned by range alone."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    if spark.conf.get(name, None) != "false":
        spark.conf.set(name, "false")
