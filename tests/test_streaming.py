"""Incremental build: the stream checkpoint is the resume state."""

import os
import tempfile

from pyspark.sql import functions as F

from helpers import ONE, T0, mixed_inputs
from basinflow.sources.readers import read_partitioned
from basinflow.streaming import incremental_build


def _land(flow, root, gauge):
    (flow.where(F.col("gauge_id") == gauge).select("date", F.col("streamflow_cms").alias("streamflow"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/camels_{gauge}"))


def test_second_run_only_processes_new_gauges(spark):
    root = tempfile.mkdtemp(prefix="bf-stream-", dir="/tmp")
    flow1, obs1, fc1, _ = mixed_inputs(spark, gauge="0001")
    flow2, obs2, fc2, _ = mixed_inputs(spark, gauge="0002")
    obs, fc = obs1.unionByName(obs2), fc1.unionByName(fc2)
    blocks = {"test": (str(T0), str(T0))}
    out, ckpt = f"{root}/out", f"{root}/ckpt"
    _land(flow1, f"{root}/landing", "0001")
    assert incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt) == 1
    assert read_partitioned(spark, out).select("basin_id").distinct().collect()[0][0] == "0001"
    # nothing new: no batch runs, output unchanged
    assert incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt) == 0
    _land(flow2, f"{root}/landing", "0002")
    assert incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt) == 1
    res = read_partitioned(spark, out)
    assert sorted(r.basin_id for r in res.select("basin_id").distinct().collect()) == ["0001", "0002"]
    assert res.count() == 2 * 106


def test_group_of_an_invalidated_gauge_disappears(spark):
    root = tempfile.mkdtemp(prefix="bf-stream-", dir="/tmp")
    flow, obs, fc, _ = mixed_inputs(spark, gauge="0004")
    blocks = {"test": (str(T0), str(T0))}
    out, ckpt = f"{root}/out", f"{root}/ckpt"
    _land(flow, f"{root}/landing", "0004")
    incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt)
    assert os.path.isdir(f"{out}/split=test/basin_id=0004")
    # a copy of one day arrives: the sequence is too long, the sample goes
    (flow.where(F.col("date") == F.lit(T0 - 2 * ONE)).select("date", F.col("streamflow_cms").alias("streamflow"))
     .coalesce(1).write.option("header", True).csv(f"{root}/landing/more/camels_0004"))
    assert incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt) == 1
    assert not os.path.isdir(f"{out}/split=test/basin_id=0004")


def test_gauge_split_over_two_batches_is_rebuilt_whole(spark):
    root = tempfile.mkdtemp(prefix="bf-stream-", dir="/tmp")
    flow, obs, fc, _ = mixed_inputs(spark, gauge="0003")
    rows = flow.select("date", F.col("streamflow_cms").alias("streamflow")).orderBy("date").collect()
    half = len(rows) // 2
    blocks = {"test": (str(T0), str(T0))}
    out, ckpt = f"{root}/out", f"{root}/ckpt"
    for i, part in enumerate((rows[:half], rows[half:])):
        spark.createDataFrame(part, "date date, streamflow double").coalesce(1).write.mode("overwrite") \
            .option("header", True).csv(f"{root}/landing/camels_0003/part{i}")
    # one file per micro-batch: the gauge's record arrives in two halves
    n = incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt, max_files_per_trigger=1)
    assert n == 2
    assert read_partitioned(spark, out).count() == 106


def test_a_batch_opens_only_its_gauges_files_and_builds_once(spark, monkeypatch):
    from basinflow.streaming import incremental as I
    root = tempfile.mkdtemp(prefix="bf-stream-", dir="/tmp")
    obs = fc = None
    for gauge in ("0005", "0006"):
        flow, o, f, _ = mixed_inputs(spark, gauge=gauge)
        obs, fc = (o, f) if obs is None else (obs.unionByName(o), fc.unionByName(f))
        _land(flow, f"{root}/landing", gauge)
    blocks = {"test": (str(T0), str(T0))}
    out, ckpt, opened, built = f"{root}/out", f"{root}/ckpt", [], []
    read, build = I.landed_flow, I.build_batch

    def counting_read(spark, files):
        opened.append(files)
        df = read(spark, files)
        assert sorted(x.removeprefix("file://") for x in df.inputFiles()) == sorted(x.removeprefix("file://") for x in files)
        return df

    monkeypatch.setattr(I, "landed_flow", counting_read)
    monkeypatch.setattr(I, "build_batch", lambda *a: built.append(1) or build(*a))
    incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt)
    assert sum(len(x) for x in opened) == 2 and len(built) == 1
    # Another file of one gauge: both its files are opened, the other gauge's is not.
    (mixed_inputs(spark, gauge="0006")[0].limit(1).select("date", F.col("streamflow_cms").alias("streamflow"))
     .coalesce(1).write.option("header", True).csv(f"{root}/landing/more/camels_0006"))
    opened.clear()
    incremental_build(spark, f"{root}/landing", obs, fc, blocks, out, ckpt)
    assert len(opened) == 1 and len(opened[0]) == 2 and all("camels_0006" in x for x in opened[0]) and len(built) == 2
    assert all(os.path.isdir(f"{out}/split=test/basin_id={g}") for g in ("0005", "0006"))
    assert not os.path.isdir(f"{ckpt}/staged/epoch=0")


def test_a_removed_file_is_no_part_of_the_record(spark):
    from basinflow.streaming import incremental as I
    root = tempfile.mkdtemp(prefix="bf-stream-", dir="/tmp")
    batch = spark.createDataFrame([("0007", f"file://{root}/gone%20now.csv"), ("0007", f"file://{root}/is here.csv"), ("0008", "x")],
                                  "gauge_id string, file string")
    with open(f"{root}/is here.csv", "w") as f:
        f.write("date,streamflow\n")
    I.record_files(batch, f"{root}/state", 0)
    assert I.files_of(batch.where("gauge_id = '0007'").select("gauge_id").distinct(), f"{root}/state") == [f"file://{root}/is here.csv"]
