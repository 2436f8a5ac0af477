"""Caller hooks (X1, X2), shuffled batches (W6), the generated fan-out."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import ONE, T0, build, mixed_inputs
from basinflow.operators import samples as smp
from basinflow.operators.calendar import calendar_dates, issue_days_between
from basinflow.operators.evaluate import apply_static_hook, score_batches
from basinflow.operators.ranking import assign_batches, resume_candidates, shuffle_key


def test_static_hook_column_function(spark):
    st = spark.createDataFrame([("a", [1.0, 2.0])], "gauge_id string, features array<double>")
    out = apply_static_hook(st, lambda c: F.transform(c, lambda x: x * 2))
    assert out.collect()[0].features == [2.0, 4.0]
    assert apply_static_hook(st, None) is st


def test_score_batches_runs_predictor_on_executors(spark):
    df = spark.createDataFrame([("s1", 0, 1.0, 10.0), ("s1", 1, 2.0, 20.0), ("s2", 0, 3.0, 30.0)],
                               "k string, step int, y double, x double")

    def predict(pdf: pd.DataFrame) -> pd.Series:
        return pdf["x"] / 10.0

    out = score_batches(df, predict, ["k", "step"], "k string, step int, y double, y_hat double")
    got = sorted((r.k, r.step, r.y, r.y_hat) for r in out.collect())
    assert got == [("s1", 0, 1.0, 1.0), ("s1", 1, 2.0, 2.0), ("s2", 0, 3.0, 3.0)]


def test_shuffled_batches_are_a_permutation_and_reproducible(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"))
    a = assign_batches(df.withColumn("h", shuffle_key(["k"], 7)), 16, ["h", "k"])
    b = assign_batches(df.withColumn("h", shuffle_key(["k"], 7)), 16, ["h", "k"])
    c = assign_batches(df.withColumn("h", shuffle_key(["k"], 8)), 16, ["h", "k"])
    ra = {r.k: (r.batch_id, r.pos_in_batch) for r in a.collect()}
    rb = {r.k: (r.batch_id, r.pos_in_batch) for r in b.collect()}
    rc = {r.k: (r.batch_id, r.pos_in_batch) for r in c.collect()}
    assert ra == rb and ra != rc and len(ra) == 50
    assert sorted(p for p in ra.values()) == sorted((i // 16, i % 16) for i in range(50))


def test_only_candidates_are_built(spark):
    flow, obs, fc, cand = mixed_inputs(spark)
    blocks = {"test": (str(T0), str(T0))}
    none = cand.where("false")
    assert smp.mixed_steps(flow, obs, fc, none, blocks, 5).count() == 0
    assert smp.mixed_steps(flow, obs, fc, cand, blocks, 5).count() == 106
    other = cand.withColumn("basin_id", F.lit("zz"))
    assert smp.mixed_steps(flow, obs, fc, other, blocks, 5).count() == 0


def test_resumed_build_is_the_full_build_without_what_is_done(spark):
    flow, obs, fc, _ = mixed_inputs(spark)
    days = [T0 - 10 * ONE, T0 - 5 * ONE, T0]
    blocks = {"test": (str(days[0]), str(T0))}
    cand = spark.createDataFrame([("g1", "test", d) for d in days], "basin_id string, split string, issue_date date")
    full = smp.sample_stats(smp.mixed_steps(flow, obs, fc, cand, blocks, 5)).collect()
    left = resume_candidates(cand, cand.where(F.col("issue_date") == F.lit(T0)))
    rest = smp.sample_stats(smp.mixed_steps(flow, obs, fc, left, blocks, 5)).collect()
    assert sorted(rest) == sorted(r for r in full if r.issue_date != T0) and len(rest) == 2


def test_generated_issue_days_match_the_calendar(spark):
    blocks = {"train": ("1996-02-27", "1996-12-31"), "test": ("1997-01-03", "1998-06-01")}
    for stride in (1, 5, 7, "year-start"):
        want = sorted((s, (d - dt.date(1970, 1, 1)).days) for s, d in calendar_dates(blocks, stride))
        row = spark.range(1).select(issue_days_between(F.lit(9000), F.lit(11000), blocks, stride).alias("d")).first()
        assert sorted((x["split"], x["sday"]) for x in row["d"]) == want
        part = spark.range(1).select(issue_days_between(F.lit(9600), F.lit(9900), blocks, stride).alias("d")).first()
        assert sorted((x["split"], x["sday"]) for x in part["d"]) == [w for w in want if 9600 <= w[1] <= 9900]


def test_overlapping_splits_are_an_error():
    with pytest.raises(ValueError):
        calendar_dates({"a": ("2000-01-01", "2000-06-01"), "b": ("2000-06-01", "2000-12-01")}, 5)


def test_nan_flow_rejects_the_sample(spark):
    nan_day = T0 - 3 * ONE
    steps = build(spark, flow_value=lambda day: float("nan") if day == nan_day else 1.0)
    stats = smp.sample_stats(steps).collect()
    assert [r.reason for r in stats] == ["missing_values"]


def test_group_scope_of_steps_and_of_samples_agree(spark):
    flow, obs, fc, _ = mixed_inputs(spark, obs_nulls={"precip": {T0 - 2 * ONE}})
    days = [T0 - 200 * ONE, T0]
    blocks = {"test": (str(days[0]), str(T0))}
    cand = spark.createDataFrame([("g1", "test", d) for d in days], "basin_id string, split string, issue_date date")
    steps = smp.mixed_steps(flow, obs, fc, cand, blocks, 200)
    kept = smp.apply_scope(steps, "group").select("sday").distinct().count()
    assert kept == smp.scope_samples(smp.sample_stats(steps), "group").count() == 0


def test_model_is_loaded_once_a_worker(spark, tmp_path):
    """Tasks of one Python worker share the model; each worker loads its own."""
    import os
    log = str(tmp_path)

    def load():
        import uuid
        with open(f"{log}/{os.getpid()}-{uuid.uuid4().hex}", "w"):
            pass
        return 3.0

    def predict(pdf, factor):
        with open(f"{log}/worker-{os.getpid()}", "w"):
            pass
        return pdf["y"] * factor

    df = spark.range(200).selectExpr("cast(id as string) k", "cast(0 as int) step", "cast(id as double) y").repartition(40)
    for _ in range(3):
        out = score_batches(df, predict, ["k", "step"], "k string, step int, y double, y_hat double", load=load, model=f"m-{log}")
        assert all(r.y_hat == 3 * r.y for r in out.collect())
    files = os.listdir(log)
    workers = {x.split("-")[1] for x in files if x.startswith("worker-")}
    loads = [x.split("-")[0] for x in files if not x.startswith("worker-")]
    assert sorted(loads) == sorted(workers) and len(loads) < 40
    with pytest.raises(ValueError):
        score_batches(df, predict, ["k", "step"], "k string", load=load)


def test_worker_keeps_few_models():
    from basinflow.operators import evaluate as E
    made = []
    for k in [*range(6), 5, 0]:
        assert E.worker_model(f"few{k}", lambda k=k: made.append(k) or k) == k
    assert made == [0, 1, 2, 3, 4, 5, 0] and len(E._LOADED) <= E.MAX_LOADED
