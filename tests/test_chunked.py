"""Resumable chunked writes and statistics merged from parts."""
import math
import random

import pytest
from pyspark.sql import functions as F

from basinflow.operators import scaling as S
from basinflow.operators.ranking import assign_batches
from basinflow.sinks import chunked as K

SAMPLES = "basin_id string, split string, forecast_date string, x double"


@pytest.fixture
def samples(spark):
    r = random.Random(4)
    rows = [(f"{g:04d}", r.choice(["train", "test"]), f"2000-01-{d:02d}", r.random()) for g in range(40) for d in range(1, 1 + r.randint(0, 12))]
    return spark.createDataFrame(rows, SAMPLES).cache()


def full(samples, size):
    b = assign_batches(samples, size, ["basin_id", "forecast_date"], within=["split"])
    return sorted((r["split"], r["batch_id"], r["pos_in_batch"], r["basin_id"], r["forecast_date"]) for r in b.collect())


def got(df):
    return sorted((r["split"], r["batch_id"], r["pos_in_batch"], r["basin_id"], r["forecast_date"]) for r in df.collect())


class Killed(Exception):
    pass


def test_a_killed_run_keeps_its_chunks_and_the_next_writes_the_rest(spark, samples, tmp_path):
    path, built = str(tmp_path / "out"), []

    def build(chunk, die_at=None):
        built.append(chunk.number)
        if chunk.number == die_at:
            raise Killed
        return samples.where(chunk.holds("basin_id"))

    with pytest.raises(Killed):
        K.write_chunks(spark, path, samples, lambda c: build(c, 3), 7, chunks=6)
    assert built == [0, 1, 2, 3] and len(K.entries(spark, path)) == 3
    first = K.read_chunks(spark, path).count()
    assert 0 < first < samples.count()
    left = K.remaining(spark, path, samples)
    assert left.count() == samples.count() - first
    assert left.join(K.read_chunks(spark, path), ["basin_id", "split", "forecast_date"]).count() == 0
    # Died while writing: files without a log entry, which are no part of the output.
    samples.limit(5).write.parquet(K._folder(path, 3) + "/split=train")
    assert K.read_chunks(spark, path).count() == first
    built.clear()
    assert K.write_chunks(spark, path, samples, build, 7, chunks=99) == len(built) == len(K.plan(spark, path)["bounds"]) + 1 - 3
    assert built[0] == 3
    assert got(K.read_chunks(spark, path)) == full(samples, 7)
    assert K.write_chunks(spark, path, samples, build, 7) == 0
    assert K.remaining(spark, path, samples).count() == 0


def test_state_comes_from_the_log(spark, samples, tmp_path):
    path = str(tmp_path / "out")
    assert [r["next_batch"] for r in K.chunk_state(spark, path, ["train"]).collect()] == [0]
    K.write_chunks(spark, path, samples, lambda c: samples.where(c.holds("basin_id")), 5, chunks=3, limit=2)
    state = {r["split"]: r for r in K.chunk_state(spark, path, ["train", "test", "none"]).collect()}
    rows = got(K.read_chunks(spark, path))
    for split in ("train", "test"):
        mine = [x for x in rows if x[0] == split]
        last = max(mine, key=lambda x: (x[1], x[2]))
        assert (state[split]["last_basin"], state[split]["last_date"]) == last[3:]
        assert state[split]["next_batch"] == -(-len(mine) // 5)
    assert state["none"]["next_batch"] == 0 and state["none"]["last_basin"] is None


def test_chunks_without_samples_and_other_plans(spark, samples, tmp_path):
    path = str(tmp_path / "out")
    some = F.col("basin_id") > "0030"
    K.write_chunks(spark, path, samples, lambda c: samples.where(c.holds("basin_id") & some), 5, chunks=4)
    assert got(K.read_chunks(spark, path)) == full(samples.where(some), 5)
    with pytest.raises(ValueError):
        K.write_chunks(spark, path, samples, lambda c: samples, 6)
    empty = str(tmp_path / "empty")
    K.write_chunks(spark, empty, samples.where("false"), lambda c: samples.where("false"), 5)
    assert K.read_chunks(spark, empty) is None


def test_bounds_cut_rows_evenly_and_between_keys(spark):
    rows = [("a",)] * 500 + [(f"k{k:03d}",) for k in range(400)] + [(None,)] * 3
    df = spark.createDataFrame(rows, "basin_id string")
    bounds = K.chunk_bounds(df, "basin_id", 8)
    assert bounds == sorted(set(bounds)) and len(bounds) <= 7
    cuts = K.chunks_of({"bounds": bounds})
    counts = [df.where(c.holds("basin_id")).count() for c in cuts]
    assert sum(counts) == 900 and max(counts[1:]) < 300


def test_predicates_reach_the_scan(spark, samples, tmp_path):
    samples.write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s")).where(K.Chunk(1, "0010", "0020").holds("basin_id"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(basin_id,0010)" in plan and "LessThan(basin_id,0020)" in plan


def test_merged_moments_equal_one_pass(spark):
    r = random.Random(9)
    rows = [(g, 1e9 + r.random() if g != 3 else None, r.gauss(g, 3) if r.random() < 0.9 else None, None) for g in range(6) for _ in range(50)]
    df = spark.createDataFrame(rows, "g int, big double, x double, none double")
    cols = ["big", "x", "none"]
    parts = S.partial_moments(df, cols, ("g",))
    twice = S.merge_moments(S.merge_moments(parts.withColumn("h", F.col("g") % 2), ("h",)).select("h", "feature", "n", "mean", "m2"))
    want = {x["feature"]: x for x in S.fit_scaler(df, cols).collect()}
    for merged in (S.merge_moments(parts), twice):
        found = {x["feature"]: x for x in merged.collect()}
        assert found.keys() == want.keys()
        for c in ("big", "x"):
            assert math.isclose(found[c]["mean"], want[c]["mean"], rel_tol=1e-12)
            assert math.isclose(found[c]["std"], want[c]["std"], rel_tol=1e-6)
        assert found["none"]["n"] == 0 and found["none"]["mean"] is None and want["none"]["mean"] is None


def test_log_moments_equal_a_fit_over_the_samples(spark, tmp_path):
    r = random.Random(2)
    rows = [(f"{g}", "train" if g % 3 else "test", f"d{d}", [[r.random(), float(g)] for _ in range(4)], [r.random() for _ in range(4)])
            for g in range(12) for d in range(3)]
    df = spark.createDataFrame(rows, "basin_id string, split string, forecast_date string, dynamic_inputs array<array<float>>, targets array<float>")
    path = str(tmp_path / "out")
    for limit in (1, None):
        K.write_chunks(spark, path, df, lambda c: df.where(c.holds("basin_id")), 4, chunks=3, limit=limit, moments=lambda d: S.packed_moments(d, ["a", "b"]))
    merged = {x["feature"]: x for x in S.merge_moments(K.chunk_moments(spark, path).where("split = 'train'").drop("split")).collect()}
    flat = df.where("split = 'train'").select(F.explode(F.arrays_zip("dynamic_inputs", "targets")).alias("e")).select(
        F.col("e.dynamic_inputs")[0].alias("a"), F.col("e.dynamic_inputs")[1].alias("b"), F.col("e.targets").alias("target"))
    for x in S.fit_scaler(flat, ["a", "b", "target"]).collect():
        assert math.isclose(merged[x["feature"]]["mean"], x["mean"], rel_tol=1e-9)
        assert math.isclose(merged[x["feature"]]["std"], x["std"], rel_tol=1e-9)


def test_normalised_samples_are_built_once(spark):
    """The plan of the result reads the written samples and nothing above them."""
    from basinflow.plans.queries import REGISTRY
    df = REGISTRY["normalize"][0](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    assert all("mixed_by_split" in x for x in df.inputFiles())
