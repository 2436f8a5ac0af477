"""Incremental, resumable sample building with Structured Streaming.

The reference flushes finished samples every few results and, after a
crash, resumes from what it had written.  Here gauge records land as files
(one file or folder per gauge); a file stream with ``trigger(availableNow)``
picks up every file not yet processed -- the stream checkpoint is the resume
state.  A micro-batch says which gauges received files; an index of gauges and files,
kept beside the stream state, says which earlier files they have.
``foreachBatch`` opens just these (a gauge whose files were split over two
batches is simply rebuilt), builds the samples once into a staging folder, and
from there replaces the (split, gauge) groups by a dynamic partition overwrite;
groups of those gauges that have no sample any more are removed.  Re-running an
epoch after a failure does the same again (its index rows and staging folder
are overwritten), so the output is exactly-once in effect.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import gauge_suffix, iso_date, nan_to_null
from ..operators import calendar as cal
from ..operators import samples as smp
from ..sinks.tables import delete_folder, path_exists
from ..sinks.writers import drop_groups, write_partitioned

FLOW_STREAM_SCHEMA = "date DATE, streamflow DOUBLE"


def _flow_columns(df: DataFrame) -> DataFrame:
    return df.select(F.regexp_extract(F.input_file_name(), r"camels_(\d+)", 1).alias("gauge_id"),
                     "date", nan_to_null("streamflow").alias("streamflow_cms"), F.input_file_name().alias("file"))


def flow_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of per-gauge CSV files; gauge id from the file path."""
    r = (spark.readStream.schema(FLOW_STREAM_SCHEMA).option("header", True)
         .option("recursiveFileLookup", True))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _flow_columns(r.csv(path))


def _index_path(state_path: str) -> str:
    return f"{state_path.rstrip('/')}/gauge_files"


def record_files(batch: DataFrame, state_path: str, epoch_id: int) -> DataFrame:
    """The (gauge_id, file) pairs of a micro-batch, added to the index."""
    path = f"{_index_path(state_path)}/epoch={epoch_id}"
    batch.select("gauge_id", "file").distinct().write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.parquet(path)


def files_of(touched: DataFrame, state_path: str) -> list[str]:
    """Every file of the touched gauges that any micro-batch has brought."""
    index = touched.sparkSession.read.parquet(_index_path(state_path)).select("gauge_id", "file")
    # A micro-batch's gauges times the files of a gauge: what the reader lists.
    found = index.join(touched, "gauge_id", "left_semi").select("file").distinct().collect()
    # Landed files that have been removed or replaced since are no part of the record.
    return sorted(f for f in (unquote(r["file"]) for r in found) if path_exists(touched.sparkSession, f))


def landed_flow(spark: SparkSession, files: list[str]) -> DataFrame:
    """Static read of the named landed files."""
    df = _flow_columns(spark.read.schema(FLOW_STREAM_SCHEMA).option("header", True).csv(files))
    return df.drop("file")


def build_batch(flow: DataFrame, obs: DataFrame, fcst: DataFrame, blocks, stride=5,
                nan_policy: str = "all", scope: str = "sample") -> DataFrame:
    """Accepted long-form samples of the gauges present in ``flow``."""
    gauges = flow.select(F.col("gauge_id").alias("basin_id")).distinct()
    obs = obs.join(gauges, gauge_suffix(obs["basin_id"]) == gauges["basin_id"], "left_semi")
    fcst = fcst.join(gauges, gauge_suffix(fcst["basin_id"]) == gauges["basin_id"], "left_semi")
    cand = cal.candidates(gauges, blocks, stride, key="basin_id")
    steps = smp.mixed_steps(flow, obs, fcst, cand, blocks, stride, nan_policy=nan_policy)
    return smp.apply_scope(steps, scope).select(
        "basin_id", "split", iso_date("issue_date").alias("forecast_date"), "step", "flag",
        *smp.WEATHER3, "target")


def incremental_build(spark: SparkSession, flow_dir: str, obs: DataFrame, fcst: DataFrame,
                      blocks, out_path: str, checkpoint_path: str, stride=5,
                      nan_policy: str = "all", scope: str = "sample",
                      max_files_per_trigger: int | None = None) -> int:
    """Process every landed gauge file not processed before; returns batches run."""
    epochs = []

    def process(batch: DataFrame, epoch_id: int) -> None:
        epochs.append(epoch_id)
        touched = record_files(batch, checkpoint_path, epoch_id).select("gauge_id").distinct()
        files = files_of(touched, checkpoint_path)
        if not files:
            return
        staged = f"{checkpoint_path.rstrip('/')}/staged/epoch={epoch_id}"
        build_batch(landed_flow(spark, files), obs, fcst, blocks, stride, nan_policy, scope).write.mode("overwrite").parquet(staged)
        out = spark.read.parquet(staged)
        write_partitioned(out, out_path, keys=("split", "basin_id"))
        # Every epoch writes its groups last: rows of a touched gauge's group
        # that this epoch did not write are of samples that no longer exist.
        groups = touched.select(F.col("gauge_id").alias("basin_id"), F.explode(
            F.array(*[F.lit(s) for s in blocks])).alias("split"))
        written = out.select("split", "basin_id").distinct()
        drop_groups(groups.join(written, ["split", "basin_id"], "left_anti"), out_path)
        delete_folder(spark, staged)

    q = (flow_file_stream(spark, flow_dir, max_files_per_trigger).writeStream
         .foreachBatch(process)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return len(epochs)
